from kindred.functions.scaling import denormalise, deviation, rounded, scale

__all__ = ["denormalise", "deviation", "rounded", "scale"]
