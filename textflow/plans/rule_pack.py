"""A small pack of our own for the catalogue's tables: licence names as entities, common words as terms."""

from textflow.operators.rules import Rules

PACK = Rules(
    entities=("GNU General Public License", "Apache License", "MIT License", "Creative Commons", "GNU", "MIT"),
    terms={"licence": {"triggers": ["licensed", "released under"], "expected": ["license"], "forbidden": ["copyright"]}, "agreement": {"triggers": ["with", "under"], "expected": ["the"]}},
    actions={"release": {"triggers": ["released"], "expected": ["released"]}, "contact": {"triggers": ["@mail"], "expected": ["@"]}},
    confusions={"MIT License": ["Apache License"]},
    aliases={"Creative Commons": ["cc-by"]},
    whitelist=("license", "version"),
    fragments=("public", "general"),
    residue=("idiot", "stupid"),
    core=("gnu",),
    easy_themes=("worthless",),
    script="A-Za-zÀ-ÿ",
)
