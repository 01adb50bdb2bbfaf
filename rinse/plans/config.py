"""What the caller asks for: keys, legal characters, time zones."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

# Where a rule's characters are legal, by mode number
# (lead, middle, trail). A rule without a mode allows them at both ends.
PLACEMENT_MODES = {
    None: (True, False, True),
    1: (True, False, False),
    2: (False, True, False),
    3: (False, False, True),
    4: (True, True, False),
    5: (False, True, True),
    6: (True, True, True),
}


def _special(chars: Iterable[str], setting: str) -> str:
    distinct = "".join(dict.fromkeys("".join(chars)))
    wrong = [char for char in distinct if char.isascii() and char.isalnum()]
    if wrong:
        raise ValueError(f"{setting}: {wrong} are letters or digits of ASCII, which are legal anyway")
    return "".join(char for char in distinct if not char.isspace())


@dataclass(frozen=True)
class PlacementRule:
    """Characters that are legal at some places of some columns only."""

    chars: str
    columns: tuple[str, ...]
    lead: bool = True
    middle: bool = False
    trail: bool = True

    @staticmethod
    def of(chars: str, entries: Sequence[int | str]) -> PlacementRule:
        """Read ``{chars: [mode?, column, ...]}``; several characters may be
        written together or separated by commas."""
        mode = entries[0] if entries and isinstance(entries[0], int) else None
        if mode not in PLACEMENT_MODES:
            raise ValueError(f"placement rule {chars!r}: no mode {mode}")
        legal = _special(chars if len(chars) == 1 else chars.replace(",", ""), "placement rule")
        if not legal:
            raise ValueError(f"placement rule {chars!r} names no special character")
        columns = tuple(entries if mode is None else entries[1:])
        lead, middle, trail = PLACEMENT_MODES[mode]
        return PlacementRule(legal, columns, lead, middle, trail)


@dataclass(frozen=True)
class CurationConfig:
    primary_key: str | None = None
    composite_keys: tuple[str, ...] = ()
    extra_allowed: str = ""
    placement: tuple[PlacementRule, ...] = ()
    input_tz: str = "GMT"
    output_tz: str = "UTC"
    #: Share of a column's values that must look like a date or timestamp before the
    #: column becomes one; 0 means that a single value is enough.
    min_match_ratio: float = 0.0
    #: Among duplicates, the row that comes first by these columns survives.
    order_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "extra_allowed", _special(self.extra_allowed, "extra_allowed"))
        seen: set[str] = set()
        for rule in self.placement:
            for column in rule.columns:
                if column in seen:
                    raise ValueError(f"column {column!r} is under two placement rules")
                seen.add(column)

    @staticmethod
    def of(
        primary_key: str | None = None,
        composite_keys: Sequence[str] | None = None,
        valid_across_allcol: Iterable[str] | None = None,
        valid_spl_chars: Mapping[str, Sequence[int | str]] | None = None,
        inputtz: str | None = None,
        outputtz: str | None = None,
        **more: object,
    ) -> CurationConfig:
        """Build a configuration from plain dictionaries and lists, which stay as they are."""
        return CurationConfig(
            primary_key=primary_key or None,
            composite_keys=tuple(composite_keys or ()),
            extra_allowed="".join(valid_across_allcol or ()),
            placement=tuple(
                PlacementRule.of(chars, entries)
                for chars, entries in (valid_spl_chars or {}).items()
            ),
            input_tz=inputtz or "GMT",
            output_tz=outputtz or "UTC",
            **more,
        )

    def rule_for(self, column: str) -> PlacementRule | None:
        return next((rule for rule in self.placement if column in rule.columns), None)

    def renamed(self, names: Mapping[str, str]) -> CurationConfig:
        """The same configuration with its column references carried through a renaming."""

        def new(column: str) -> str:
            return names.get(column, column)

        return replace(
            self,
            primary_key=new(self.primary_key) if self.primary_key else None,
            composite_keys=tuple(map(new, self.composite_keys)),
            placement=tuple(
                replace(rule, columns=tuple(map(new, rule.columns))) for rule in self.placement
            ),
            order_by=tuple(map(new, self.order_by)),
        )

    def references(self) -> tuple[str, ...]:
        keys = (self.primary_key,) if self.primary_key else ()
        placed = tuple(column for rule in self.placement for column in rule.columns)
        return keys + self.composite_keys + placed + self.order_by
