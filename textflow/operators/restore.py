"""Placeholders that a model made up, restored from the source text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions import text as T

#: What a placeholder looks like, tags that say nothing by themselves, and how product names are spelt.
MARK = r"(?i)<ENT[^>]*>"
EMPTY_TAG = r"(?i)^(ORG|SRV|ENT|VAL|BANK|POCKET|FLZZ|NUM|IDX)_?\d*$"
SHAPES = (r"[A-Z]{2,}(?:[-/][A-Z0-9]+)*", r"[A-Z][a-z]+[A-Z][A-Za-z0-9]*", r"[A-Za-z]+[-/][A-Za-z0-9]+", r"[A-Za-z]*\d+[A-Za-z]*", r"\be[A-Z][A-Za-z]+\b", r"\be-[A-Za-z]+\b")
CAPITALISED, E_NAME = r"\b[A-Z][a-z]{3,}\b", r"\be[A-Z][A-Za-z]+\b"
AFTER_WORD = (r"(?i)\bstatus\s+([A-Z0-9])\b", r"(?i)\blimit\s+([A-Z0-9])\b")
#: Rows that are Python objects at a time, at most.
ROWS = 256
#: Words of the source language that are no names however they are spelt.
COMMON_WORDS = """berapa di mana apa kapan siapa mengapa bisakah apakah nama dan atau untuk dari pada yang jika saat sudah masih dengan melalui
top up online status gratis kena unprinted refund link produk tabungan tunai tarik cek saldo biaya proses aturan keluhan cetak mutasi transaksi
rekening relawan gagal kembali lama aktif tutup buka data mulai berlaku mobile form login check teller layanan cabang reservasi limit naik""".split()


def disjoint(spans: Iterable[tuple[int, int, str]]) -> list[str]:
    """The texts of spans that don't overlap: the leftmost first, of those at one place the longest."""
    out, end = [], 0
    for start, stop, value in sorted(spans, key=lambda x: (x[0], -x[1])):
        if start >= end:
            out.append(value)
            end = stop
    return out


class Names:
    """What the names of a source text are, and which of them a placeholder stands for."""

    def __init__(self, entities: list[str], residue: Iterable[str] = ()):
        self.entities = sorted(set(entities), key=lambda e: (-len(e), e))
        self.patterns = [re.compile(T.word_pattern(e)) for e in self.entities]
        self.common = {w.lower() for w in residue} | set(COMMON_WORDS)
        self.shapes, self.capitalised, self.e_name = re.compile("|".join(SHAPES)), re.compile(CAPITALISED), re.compile(E_NAME)
        self.after, self.mark = [re.compile(p) for p in AFTER_WORD], re.compile(MARK)
        self.known = {f"<ENT_{i:02d}>": e for i, e in enumerate(self.entities)}

    def is_name(self, word: str) -> bool:
        if word.lower() in self.common:
            return False
        return word.isupper() and len(word) >= 2 or re.search("[a-z][A-Z]|[0-9]", word) is not None or word[0].isupper() and len(word) >= 4

    def of(self, source: str) -> list[str]:
        """The names of a text in order."""
        spans = [(*m.span(), m[0]) for p in self.patterns for m in p.finditer(source)]
        spans += [(*m.span(), m[0]) for p in (self.shapes, self.capitalised) for m in p.finditer(source) if self.is_name(m[0])]
        spans += [(*m.span(1), m[1].upper()) for p in self.after for m in p.finditer(source)]
        spans += [(*m.span(), m[0]) for m in self.e_name.finditer(source) if m[0].lower() not in self.common]
        return disjoint(spans)

    def by_tag(self, tag: str, source: str, names: list[str]) -> str | None:
        """The part of the source that a tag names: its first name for an organisation or a service; the tag itself, however
        its words are joined; or the entity that begins with it, or it with the entity."""
        if names and tag.upper().startswith(("ORG", "SRV")):
            return names[0]
        if re.match(EMPTY_TAG, tag):
            return None
        for joined in (tag, tag.replace("_", " "), tag.replace("_", "-")):
            loose = "".join({"-": r"[-\s_]?", " ": r"[\s_-]?"}.get(c, re.escape(c)) for c in joined)
            if len(joined) >= 2 and (m := re.search(loose, source, re.I)):
                return m[0]
        bare = re.sub("[^A-Za-z0-9]", "", tag).lower()
        for entity, pattern in zip(self.entities, self.patterns, strict=True):
            own = re.sub("[^A-Za-z0-9]", "", entity).lower()
            if bare and own and (own.startswith(bare) or bare.startswith(own)) and (m := pattern.search(source)):
                return m[0]
        return None

    def choices(self, marks: list[str], source: str, names: list[str]) -> list[tuple[str, str]]:
        """What to put for some placeholders: by their tags; if no tag tells, by their numbers; if none has one, by position."""
        found = [(m, value) for m in marks if (value := self.by_tag(m[5:-1], source, names))]
        if not found and names:
            numbers = [(m, int(m[9:-1])) for m in marks if re.fullmatch(r"(?i)<ENT.ENT_\d+>", m)]
            found = [(m, names[max(n - 1, 0)] if max(n - 1, 0) < len(names) else names[0]) for m, n in numbers]
        return found or list(zip(marks, names, strict=False))

    def restored(self, source: str, target: str) -> tuple[str, list[str]]:
        """The target with its placeholders restored, and placeholder->name for each that no entity number told. Rounds go on
        while the number of placeholders falls."""
        for mark, entity in self.known.items():
            target = target.replace(mark, entity)
        notes, names = [], self.of(source)
        marks = self.mark.findall(target)
        while marks:
            for mark, value in self.choices(marks, source, names):
                target = target.replace(mark, value, 1)
                notes.append(f"{mark}->{value}")
            left = self.mark.findall(target)
            if len(left) >= len(marks):
                break
            marks = left
        return target, notes


def restore_placeholders(df: DataFrame, source: str, target: str, entities: list[str], out: str = "restored", residue: Iterable[str] = (), notes: str | None = None) -> DataFrame:
    """df with the target's placeholders restored in `out` (and how, in the column `notes` if one is named): numbered ones by
    the entity list, others by tag, number or position among the source's names. What can't be told stays. Texts without a
    placeholder don't reach Python; a null target stays null, a null source has no names."""
    entities, residue = list(entities), list(residue)

    @F.arrow_udf("struct<text: string, notes: array<string>>")
    def fix(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names = Names(entities, residue)
        for src, tgt in batches:
            for i in range(0, len(tgt), ROWS):
                pairs = zip(src.slice(i, ROWS).to_pylist(), tgt.slice(i, ROWS).to_pylist(), strict=True)
                rows = [(None, None) if t is None else names.restored(s or "", t) for s, t in pairs]
                yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["text", "notes"])

    needs = F.coalesce(F.col(target).rlike(MARK), F.lit(False))
    fixed = df.withColumn("__fixed", fix(F.when(needs, F.col(source)), F.when(needs, F.col(target))))
    fixed = fixed.withColumn(out, F.coalesce("__fixed.text", F.col(target)))
    if notes:
        fixed = fixed.withColumn(notes, F.coalesce("__fixed.notes", F.array().cast("array<string>")))
    return fixed.drop("__fixed")
