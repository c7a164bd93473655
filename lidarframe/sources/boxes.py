"""Where a file's box of coordinates lies with respect to a predicate: inside, outside or astride.

A predicate is a tree of JSON lists: ["and", ...], ["or", ...], ["not", tree], ["in", axis, values],
["<" | "<=" | ">" | ">=" | "=", axis, value] and ["unknown"] for what coordinates do not decide. The same
function classifies files for header answers and for scans, so every file is counted by exactly one of the two.
"""

from __future__ import annotations

import json
import math

from lidarframe.sources.layouts import COORDINATES, Header

INSIDE, OUTSIDE, ASTRIDE = "inside", "outside", "astride"


class Box:
    """The options ``box`` (a predicate) and ``boxFiles`` (the files wanted, such as "astride" or "inside,astride")."""

    def __init__(self, options):
        text = options.get("box")
        self.tree = json.loads(text) if text else None
        wanted = options.get("boxFiles") or f"{INSIDE},{ASTRIDE}"
        self.wanted = set(str(wanted).split(","))
        if not self.wanted <= {INSIDE, OUTSIDE, ASTRIDE}:
            raise ValueError(f"boxFiles names inside, outside or astride, not {wanted!r}")

    def takes(self, header: Header) -> bool:
        return self.tree is None or relation(self.tree, header) in self.wanted


def relation(tree: list, header: Header) -> str:
    """INSIDE if the predicate holds for every point in the header's bounds, OUTSIDE if for none.

    Bounds are widened by a step of the scale, since some writers round them. A file without points
    is outside; bounds that are no numbers decide nothing.
    """
    if not header.point_count:
        return OUTSIDE
    ends = {}
    for axis, name in enumerate(COORDINATES):
        step = abs(header.scale[axis])
        ends[name] = header.minimum[axis] - step, header.maximum[axis] + step
    if not all(math.isfinite(e) for pair in ends.values() for e in pair):
        ends = {}
    always, never = _certain(tree, ends)
    return INSIDE if always else OUTSIDE if never else ASTRIDE


def _certain(tree: list, ends: dict[str, tuple[float, float]]) -> tuple[bool, bool]:
    """Whether a predicate holds for all points of the box, and whether for none."""
    kind, *parts = tree
    if kind in ("and", "or"):
        found = [_certain(part, ends) for part in parts]
        together, either = (all, any) if kind == "and" else (any, all)
        return together(t for t, _ in found), either(f for _, f in found)
    if kind == "not":
        always, never = _certain(parts[0], ends)
        return never, always
    if kind == "unknown" or parts[0] not in ends:
        return False, False
    low, high = ends[parts[0]]
    value = parts[1]
    if kind == "in":
        return low == high and low in value, not any(low <= v <= high for v in value)
    if kind == "=":
        return low == high == value, not low <= value <= high
    return {
        "<": (high < value, low >= value),
        "<=": (high <= value, low > value),
        ">": (low > value, high <= value),
        ">=": (low >= value, high < value),
    }[kind]


def decidable(tree: list) -> tuple[bool, bool]:
    """Whether some box may be inside, and whether some may be outside."""
    kind, *parts = tree
    if kind in ("and", "or"):
        found = [decidable(part) for part in parts]
        together, either = (all, any) if kind == "and" else (any, all)
        return together(t for t, _ in found), either(f for _, f in found)
    if kind == "not":
        inside, outside = decidable(parts[0])
        return outside, inside
    return (False, False) if kind == "unknown" else (True, True)
