"""Components of a run: what each needs and makes, and what a selection of them amounts to."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Component:
    key: str
    stage: str
    requires: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    produces: tuple[str, ...] = ()


COMPONENTS = {
    c.key: c
    for c in (
        Component("tissue_segmentation", "slide", produces=("tissue_mask",)),
        Component("fold_detection", "slide", ("tissue_mask",), ("pen_mask",), ("fold_mask",)),
        Component("pen_detection", "slide", (), ("fold_mask",), ("pen_mask",)),
        Component("staining_quality", "slide", ("tissue_mask",), ("fold_mask", "pen_mask")),
        Component("focus", "slide", ("tissue_mask",), ("fold_mask", "pen_mask")),
        Component("tile_selection", "tile", ("tissue_mask",), (), ("tile_list",)),
        Component("tile_metrics", "tile", ("tissue_mask", "tile_list")),
        Component("tile_artifacts", "tile", ("tile_list",)),
        Component("stain_normalization", "normalization", ("tissue_mask",)),
    )
}

#: Fixed order of execution.
ORDER = tuple(COMPONENTS)


@dataclass
class Plan:
    run: list[str]
    missing: dict[str, list[str]] = field(default_factory=dict)
    degraded: dict[str, list[str]] = field(default_factory=dict)
    unused: list[str] = field(default_factory=list)
    skipped: dict[str, str] = field(default_factory=dict)

    @property
    def valid(self) -> bool:
        return not self.missing


def plan(selected: set[str] | None = None, disabled: set[str] = frozenset(), supplied: set[str] = frozenset()) -> Plan:
    """What runs, in order; what it lacks (an error), what would make it better, and what supplied artifacts no
    component uses.  A supplied artifact stands for the component that makes it."""
    unknown = (set(selected or ()) | set(disabled)) - set(COMPONENTS)
    if unknown:
        raise ValueError(f"no component {', '.join(sorted(unknown))}")
    chosen = (set(COMPONENTS) if selected is None else set(selected)) - set(disabled)
    out, made, used = Plan([]), set(supplied), set()
    run = [k for k in ORDER if k in chosen and not (COMPONENTS[k].produces and set(COMPONENTS[k].produces) <= set(supplied))]
    makes = made | {a for k in run for a in COMPONENTS[k].produces}
    for k in ORDER:
        c = COMPONENTS[k]
        if k not in run:
            out.skipped[k] = "supplied" if k in chosen else "not selected"
            continue
        out.run.append(k)
        used |= set(c.requires) | set(c.optional)
        if lack := [a for a in c.requires if a not in makes]:
            out.missing[k] = lack
        if less := [a for a in c.optional if a not in makes]:
            out.degraded[k] = less
    out.unused = sorted(set(supplied) - used)
    return out
