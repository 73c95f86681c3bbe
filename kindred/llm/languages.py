"""Language identification by fusing evidence.

For every language, in log space and by Bayes' rule:

* the text: letter trigrams (bytes; A-Z lower-cased, everything but letters a blank) under a
  multinomial model per language, as a mean per trigram times at most EVIDENCE trigrams,
  because the trigrams of a text are not independent;
* the language that the markup declares, and the suffix of the address: how often texts of
  a language come with either, counted over all rows;
* the host: how its rows divide among the languages by their texts, smoothed towards the
  host's domain, and that towards the whole table.

All counts are sums of the text posteriors, grouped aggregations over all rows; a row's own
text is left out of the sums that it is judged by.  The trigram models are fitted on a bounded
sample of rows whose language is known.  The most frequent languages have a model each; the
others share one.  A text that fits the shared model best has the language that is declared
for it, if that is one of the others, and else none.

Nulls and empty texts: no letters, the other evidence decides, never accepted.  Repeated rows
each count and each get a row.  Of languages with equal posteriors the first by name wins,
the shared model last.  Kept columns named like one that is added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.sources.staging import stage

#: At most so many rows of each model are used to fit; so many languages, the most frequent, have their own.
SAMPLE = 2000
LANGUAGES = 100
#: Name of the model that all other languages share.
OTHERS = ""
ADDED = ("language", "posterior", "accepted")
BUCKETS = 1 << 16
EVIDENCE = 60
SMOOTHING = 5.0
SURE = 0.6
BATCH_ROWS = 500
_SEGMENT = 1 << 20
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Trigrams:
    """Log-probabilities: a row per bucket, a column per language."""

    languages: list[str]
    logs: np.ndarray

    def evidence(self, text: str | None) -> tuple[np.ndarray, int]:
        """Mean log-probability of the text's trigrams by language, and their number."""
        total, count = np.zeros(len(self.languages)), 0
        for buckets in trigram_buckets(text):
            total += self.logs.T @ np.bincount(buckets, minlength=BUCKETS) if len(buckets) > BUCKETS // 4 else self.logs[buckets].sum(axis=0)
            count += len(buckets)
        return total / max(1, count), count


def trigram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Hashed trigrams of a text, segment by segment; trigrams without a letter in the middle are left out."""
    data = b" " + (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS) + b" "
    for start in range(0, len(data) - 2, _SEGMENT):
        codes = np.frombuffer(data[start: start + _SEGMENT + 2], dtype=np.uint8)
        middle = codes[1:-1] != 32
        hashed = codes[:-2] * np.uint32(40503) + codes[1:-1] * np.uint32(9176) * np.uint32(257) + codes[2:] * np.uint32(2654435761)
        yield ((hashed ^ (hashed >> np.uint32(15)))[middle] & np.uint32(BUCKETS - 1)).astype(np.intp)


def fit(texts: DataFrame, sample: int = SAMPLE, own: int = LANGUAGES) -> Trigrams | None:
    """Fit on rows (id, text, language), about ``sample`` for each model, chosen by a hash of
    the id.  An empty language is none.  The ``own`` most frequent languages have a model each,
    all others one together.  None without any.  What reaches the driver: a count per model and bucket.
    """
    texts = texts.where("language <> '' and id is not null and text is not null").select("id", "text", "language")
    by_language = stage(texts.groupBy("language").count(), "languages-known")
    counts = {r["language"]: r["count"] for r in by_language.orderBy(F.desc("count"), "language").limit(own).collect()}
    if not counts:
        return None
    named = sorted(counts)
    rest = (by_language.agg(F.sum("count")).first()[0] or 0) - sum(counts.values())
    if rest:
        counts[OTHERS] = rest
    languages = [*named, OTHERS] if rest else named
    texts = texts.withColumn("language", F.when(F.col("language").isin(named), F.col("language")).otherwise(F.lit(OTHERS)))
    # A hash below sample / count takes about ``sample`` rows for a model, whatever the count.
    share = F.coalesce(*[F.when(F.col("language") == name, F.lit(min(1.0, sample / n))) for name, n in counts.items()])
    chosen = texts.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(language, np.zeros(BUCKETS, np.int64))
                for buckets in trigram_buckets(text.as_py()):
                    own += np.bincount(buckets, minlength=BUCKETS)
        for language, own in sums.items():
            found = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(own[found], pa.int64())], ["language", "bucket", "n"]
            )

    summed = chosen.select("language", "text").mapInArrow(run, "language string, bucket long, n long")
    table = summed.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    found = np.full((BUCKETS, len(languages)), 0.5)
    columns = [languages.index(x) for x in table.column("language").to_pylist()]
    found[table.column("bucket").to_numpy(), columns] += table.column("n").to_numpy()
    return Trigrams(languages, np.log(found / found.sum(axis=0)))


def _evidence(rows: DataFrame, model: Trigrams, keep: list[str]) -> DataFrame:
    """``keep``, ``__n`` trigrams and ``__e0``, ``__e1``, ...: the text's log-evidence for each model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"__e{i}" for i in range(len(model.languages))]
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                means, counts = [], []
                for text in part.column(part.num_columns - 1):
                    mean, count = shared.value.evidence(text.as_py())
                    means.append(mean * min(count, EVIDENCE))
                    counts.append(count)
                columns = np.array(means).reshape(len(counts), -1).T
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(counts, pa.int64()), *[pa.array(c.copy(), pa.float64()) for c in columns]],
                    [*keep, "__n", *names],
                )

    more = StructType.fromDDL(", ".join(["__n long", *[f"{e} double" for e in names]]))
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *more.fields]))


def _softmax(logs: list[Column]) -> list[Column]:
    most = F.greatest(*logs) if len(logs) > 1 else logs[0]
    shares = [F.exp(x - most) for x in logs]
    total = sum(shares[1:], shares[0])
    return [s / total for s in shares]


def identify(rows: DataFrame, model: Trigrams | None, keep: list[str]) -> DataFrame:
    """Add ``language``, ``posterior`` and ``accepted`` to the columns ``keep`` of each row.

    ``rows`` has text, declared, suffix, domain and host (strings, null where unknown: an unknown value is a value of
    its own) besides ``keep``.  A row is accepted if its text has letters, the best model
    has a posterior of SURE, and the language is known.  Without a model every language is null and nothing is accepted.
    """
    keep = [c for c in keep if c.lower() not in ADDED]
    kept = [F.col(f"`{c}`") for c in keep]
    named = [F.coalesce(F.lower(F.col(c)), F.lit("")).alias(f"__{c}") for c in ("declared", "suffix", "domain", "host")]
    rows = rows.select(*kept, *named, F.col("text").alias("__text"))
    if model is None:
        return rows.select(*kept, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    keys = ["__declared", "__suffix", "__domain", "__host"]
    seen = stage(_evidence(rows, model, [*keep, *keys]), "language-evidence")
    size = range(len(model.languages))
    shares = _softmax([F.col(f"__e{i}") for i in size])
    seen = seen.select("*", *[s.alias(f"__p{i}") for i, s in enumerate(shares)])
    sums = lambda name: [F.sum(f"__p{i}").alias(f"__{name}{i}") for i in size]
    hosts = stage(seen.groupBy("__domain", "__host").agg(*sums("h")), "hosts")
    domains = hosts.groupBy("__domain").agg(*[F.sum(f"__h{i}").alias(f"__d{i}") for i in size])
    whole = seen.agg(*sums("g")).first()
    whole = [whole[f"__g{i}"] or 0.0 for i in size]
    joined = seen.join(stage(hosts.join(domains, "__domain"), "host-sums"), ["__domain", "__host"])
    for key, name in (("__declared", "c"), ("__suffix", "s")):
        joined = joined.join(stage(seen.groupBy(key).agg(*sums(name)), "likelihoods"), key)

    # Sums over all rows but this one; rounding may leave less than nothing.
    def others(name: str) -> list[Column]:
        return [F.greatest(F.col(f"__{name}{i}") - F.col(f"__p{i}"), F.lit(0.0)) for i in size]

    rest = [F.greatest(F.lit(whole[i]) - F.col(f"__p{i}"), F.lit(0.0)) for i in size]
    added = lambda columns: sum(columns, F.lit(0.0))

    def smoothed(counts: list[Column], towards: list[Column]) -> list[Column]:
        return [(c + SMOOTHING * t) / (added(counts) + SMOOTHING) for c, t in zip(counts, towards)]

    def step(frame: DataFrame, name: str, columns: list[Column]) -> DataFrame:
        return frame.select("*", *[c.alias(f"__{name}{i}") for i, c in enumerate(columns)])

    ready = step(step(joined, "r", rest), "a", others("d"))
    table = [F.col(f"__r{i}") for i in size]
    prior = [(r + 1) / (added(table) + len(size)) for r in table]
    ready = step(ready, "t", smoothed([F.col(f"__a{i}") for i in size], prior))
    ready = step(ready, "b", others("h"))
    logs = [F.col(f"__e{i}") + F.log(x) for i, x in enumerate(smoothed([F.col(f"__b{i}") for i in size], [F.col(f"__t{i}") for i in size]))]
    for name in ("c", "s"):
        # How likely a text of the language comes with this value; one unit of smoothing, spread by the value's frequency,
        # with one row more, so that a value seen only here is possible.
        counts = others(name)
        spread = (added(counts) + 1) / (added(table) + 1)
        logs = [log + F.log((c + SMOOTHING * spread) / (r + SMOOTHING)) for log, c, r in zip(logs, counts, table)]
    ready = step(ready, "l", logs)
    ready = step(ready, "q", _softmax([F.col(f"__l{i}") for i in size]))
    final = [F.col(f"__q{i}") for i in size]
    best = F.greatest(*final) if len(final) > 1 else final[0]
    own = [name for name in model.languages if name != OTHERS]
    undeclared = (F.col("__declared") == "") | F.col("__declared").isin(own)
    meant = [F.lit(name) if name != OTHERS else F.when(~undeclared, F.col("__declared")) for name in model.languages]
    # Nested, not coalesced: where the shared model is best, no language is an answer, too.
    language = F.lit(None).cast("string")
    for q, name in reversed(list(zip(final, meant))):
        language = F.when(q == best, name).otherwise(language)
    ready = ready.select(*kept, "__n", language.alias("language"), best.alias("posterior"))
    accepted = F.coalesce((F.col("__n") > 0) & (F.col("posterior") >= SURE) & F.col("language").isNotNull(), F.lit(False))
    # Staged: a filter on the result would be pushed down the steps above, each of which names those before it many times.
    return stage(ready.select(*kept, "language", "posterior", accepted.alias("accepted")), "identified")


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, suffix, domain and host of raw pages (page_id, url, html).

    Text: without scripts, styles, comments and tags.  Declared: the primary subtag of the html element's lang.  Host: between
    scheme and path, without user and port; suffix: its last label; domain: its last two.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    empty_as_null = lambda c: F.when(c != "", c)
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        "page_id", text.alias("text"),
        empty_as_null(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)""", 1)).alias("declared"),
        empty_as_null(F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"),
        empty_as_null(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"), empty_as_null(host).alias("host"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same for documents: the declared language is their ``lang``, the host their source."""
    none = F.lit(None).cast("string")
    return docs.select(
        *docs.columns, F.col("lang").alias("declared"), none.alias("suffix"), none.alias("domain"), F.col("source").alias("host")
    )


def fit_documents(docs: DataFrame) -> Trigrams | None:
    return fit(docs.select(F.col("doc_id").alias("id"), "text", F.lower("lang").alias("language")))
