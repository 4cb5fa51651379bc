"""Interval operators: pure ``DataFrame -> DataFrame`` functions."""

from .geometry import expand, flank, set_width, shift, tile
from .islands import periods_and_gaps
from .pairwise import count_overlaps, nearest, overlap, subtract, suggest_bin_width
from .ranges import intersect_ranges, setdiff_ranges, union_ranges
from .single import cluster, complement, coverage, disjoin, merge
from .sorting import sort_bedframe

__all__ = [
    "cluster", "complement", "count_overlaps", "coverage", "disjoin", "expand", "flank", "intersect_ranges", "merge", "nearest", "overlap",
    "periods_and_gaps", "set_width", "setdiff_ranges", "shift", "sort_bedframe", "subtract", "suggest_bin_width", "tile", "union_ranges",
]
