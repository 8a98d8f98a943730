"""Rule packs: lists of names, terms and actions, read from YAML or made here, and what they compile to."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions import text
from textflow.operators import dictionary


#: Targets with a gap where a name should be.
HOLLOW = r"<ENT[^>]*>|بطاقة\s+[؟،]|[؟]\s*$|سعر\s+إصدار|الحصول على بطاقة\s+؟"


@dataclass(frozen=True)
class Rules:
    """entities: names that must survive. terms, actions: name -> {"triggers": [...], "expected": [...], "forbidden": [...]}.
    confusions: entity -> names it must not turn into. aliases: entity -> accepted translations. whitelist: Latin words that
    may stay; residue: words that must not. core: entities whose loss is serious; easy_themes: low-value topics.
    script: the target's characters."""

    entities: tuple[str, ...] = ()
    terms: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    actions: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    confusions: dict[str, list[str]] = field(default_factory=dict)
    aliases: dict[str, list[str]] = field(default_factory=dict)
    whitelist: tuple[str, ...] = ()
    fragments: tuple[str, ...] = ()
    residue: tuple[str, ...] = ()
    keep_terms: tuple[str, ...] = ()
    core: tuple[str, ...] = ()
    easy_themes: tuple[str, ...] = ()
    hollow: str = HOLLOW
    script: str = text.ARABIC

    @property
    def longest_first(self) -> list[str]:
        """Entities in masking order: by length, then by name, so that numbers don't depend on set order."""
        return dictionary.masking_order(self.entities)

    @property
    def must_translate(self) -> list[str]:
        """Lower-case words that may not stay: residue, and ASCII triggers of terms other than keep_terms."""
        words = {w.lower() for w in self.residue}
        words |= {t.lower() for name, spec in self.terms.items() if name not in self.keep_terms for t in spec.get("triggers", []) if t.isascii()}
        return sorted(words)


def load(path: str) -> Rules:
    """Rules from a YAML file with the fields of Rules."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return Rules(**{k: tuple(v) if isinstance(v, list) else v for k, v in data.items()})


def mask_entities(df: DataFrame, column: str, rules: Rules, masked: str = "masked", found: str = "entities", streamed: bool = True) -> DataFrame:
    """df with the entities of a text (null: empty) replaced by <ENT_nn>, longest first, and those found, in that order. An entity
    counts as found if it is in the text as masked so far. One pass over the text, whatever the number of entities."""
    both = df.withColumn("__mask", dictionary.masked(F.col(column), rules.longest_first, streamed))
    return both.withColumns({masked: F.col("__mask.masked"), found: F.col("__mask.found")}).drop("__mask")


def restore_entities(c: Column, rules: Rules) -> Column:
    """Marks of entities replaced by the names again (null: empty); other marks stay."""
    return dictionary.unmasked(c, rules.longest_first)


def terms_in(c: Column, rules: Rules) -> Column:
    """Terms with a trigger in a text (in any case; up to 4 characters as a word of its own), in the order of the rules."""
    return dictionary.groups_in(F.lower(c), _triggers(rules.terms), edges=lambda word: len(word) <= 4)


def actions_in(c: Column, rules: Rules) -> Column:
    return dictionary.groups_in(F.lower(c), _triggers(rules.actions))


def _triggers(specs: dict[str, dict[str, list[str]]], kind: str = "triggers") -> dict[str, list[str]]:
    return {name: [w.lower() for w in spec.get(kind, [])] for name, spec in specs.items()}


def annotate(df: DataFrame, column: str, rules: Rules) -> DataFrame:
    """df with masked, entities, terms and actions."""
    return mask_entities(df, column, rules, streamed=False).withColumns({"terms": terms_in(F.col(column), rules), "actions": actions_in(F.col(column), rules)})
