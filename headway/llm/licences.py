"""Licence scans by digest of a canonical text.

A text is brought to a canonical form: ASCII letters in lower case, copyright lines out,
punctuation of any script and white space reduced to single spaces, equivalent spellings made
one. The SHA-256 of the form is joined to the digests of known licences. Whole documents are
looked up, and so is every whole line, because notices stand on lines of their own. The known
digests are a fixed table of this module, so its broadcast has a fixed size.

Copyright lines are those that begin, behind comment marks, with the word and have a sign or a
year; with a sign and have a year; with a sign at the head of a text; paragraphs of their own of
one line of up to 80 characters that begins with the word; ``all rights reserved`` alone. What
licence texts have for themselves (the foundation's line, lines with a place for year and name)
goes as a phrase, wherever lines break. Other lines that begin so, list items with ``(c)`` or
lines of re-wrapped bodies, stay. A copyright line set into one line with a body takes it along.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import document_keys
from headway.llm.licence_texts import KNOWN
from headway.session import materialise

_COMMENT = r"[ \t#*/;%!<>.-]*"
_GAP = r"[\s#*/;%!-]+"
# In this order: what licences say of themselves, signs at the head, lines, paragraphs.
COPYRIGHT = [
    (re.compile(
        rf"copyright{_GAP}(?:\(c\){_GAP})?(?:[<\[{{](?:year|yyyy)[^>\]}}]{{0,20}}[>\]}}]{_GAP}[<\[{{][^>\]}}]{{0,80}}[>\]}}]"
        rf"|year{_GAP}name{_GAP}of{_GAP}author"
        rf"|[0-9]{{4}}(?:,{_GAP}[0-9]{{4}})*{_GAP}free{_GAP}software{_GAP}foundation,{_GAP}inc\.,?(?:{_GAP}<https?://[^>\s]*>)?)"
    ), " "),
    (re.compile(rf"\A(?:{_COMMENT}(?:(?:\(c\)|©)[^\n]*)?(?:\n|\Z))+"), ""),
    (re.compile(
        rf"^{_COMMENT}(?:(?:\(c\)|©)[^\n]*[0-9]{{4}}[^\n]*"
        r"|copyright\b[^\n]*(?:\(c\)|©|[0-9]{4})[^\n]*|all rights reserved[ \t.]*)$", re.MULTILINE
    ), ""),
    (re.compile(rf"(?:\A|\n{_COMMENT}\n){_COMMENT}copyright\b[^\n]{{0,80}}(?:\n{_COMMENT}\n|\n?\Z)"), "\n\n"),
]
_HINTS = ("copyright", "(c)", "\xa9", "all rights reserved")
_ASCII_MARKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Spellings that mean the same, applied in this order; an empty right side drops the phrase.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "license"),
    ("licenses", "license"),
    ("licenced", "licensed"),
    ("released under", "licensed under"),
    ("available under", "licensed under"),
    ("distributed under", "licensed under"),
    ("provided under", "licensed under"),
    *((f"this {what} is licensed under", "licensed under")
      for what in ("work", "software", "project", "file", "code", "program", "document")),
    ("creative commons", "cc"),
    ("attribution", "by"),
    ("non commercial", "nc"),
    ("noncommercial", "nc"),
    ("share alike", "sa"),
    ("sharealike", "sa"),
    ("gnu general public license", "gpl"),
    ("https", "http"),
    *((f"v{n}", str(n)) for n in range(1, 5)),
    ("version", ""),
    ("the", ""),
)
_REPLACED = [
    (f" {old.replace(' ', '  ')} ".encode(), (f" {new.replace(' ', '  ')} " if new else " ").encode())
    for old, new in SPELLINGS
]
_FOUND = pa.struct([("digest", pa.string()), ("lines", pa.list_(pa.string()))])


@cache
def _is_mark(character: str) -> bool:
    """Punctuation, symbols and separators beyond ASCII."""
    return character > "\x7f" and (character == "\ufeff" or unicodedata.category(character)[0] in "PSZ")


def _without_marks(text: str) -> str:
    """Marks beyond ASCII as blanks; a text has few different ones."""
    marks = [c for c in set(text) if _is_mark(c)]
    if len(marks) > 16:
        return text.translate({ord(c): " " for c in marks})
    for c in marks:
        text = text.replace(c, " ")
    return text


def words(text: str) -> list[bytes]:
    """Lower-case words without those of copyright lines."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # ASCII letters only
    if any(h in text for h in _HINTS):
        text = text.replace("\r\n", "\n")
        for pattern, instead in COPYRIGHT:
            text = pattern.sub(instead, text)
    if not text.isascii():
        text = _without_marks(text)
    return text.encode("utf-8", "surrogatepass").translate(_ASCII_MARKS).split()


def canonical(found: list[bytes]) -> bytes:
    """The canonical form of words."""
    # Two spaces between words: neighbouring phrases do not share one.
    out = b" " + b"  ".join(found) + b" "
    for old, new in _REPLACED:
        out = out.replace(old, new)
    return b" ".join(out.split())


def digest(text: str | None) -> str:
    """SHA-256 of the canonical form; null counts as empty."""
    return hashlib.sha256(canonical(words(text or ""))).hexdigest()


def telling_words() -> frozenset[bytes]:
    """Words of which every text has one whose canonical form is a known one.

    Such a word goes through the spellings unchanged: a rule that writes it has read it.
    """
    safe = set()
    for _, text in KNOWN:
        mine = set(canonical(words(text)).split())
        mine -= {w.encode() for old, new in SPELLINGS for w in set(new.split()) - set(old.split())}
        if not mine & safe:
            safe.add(max(mine, key=lambda w: (len(w), w)))
    return frozenset(safe)


def known_licences(spark: SparkSession) -> DataFrame:
    """(digest, licence) of the known texts and notices."""
    rows = sorted({(digest(text), name) for name, text in KNOWN})
    known = spark.createDataFrame(rows, "digest string, licence string")
    return known.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(text: Column) -> Column:
    """Struct of the text's ``digest`` and the digests of its ``lines`` that can be known."""
    telling = telling_words()

    @F.arrow_udf("struct<digest:string,lines:array<string>>")
    def digests(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            lines = set()
            for line in (text or "").split("\n"):
                found = words(line)
                if not telling.isdisjoint(found):
                    lines.add(hashlib.sha256(canonical(found)).hexdigest())
            out.append({"digest": digest(text), "lines": sorted(lines)})
        return pa.array(out, _FOUND)

    return digests(text)


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, digest, licence, notices.

    ``digest`` is that of the whole canonical text, ``licence`` the known licence whose
    text it is, else null; ``notices`` lists the licences whose notice is a whole line, by
    name. Null and empty texts have the digest of the empty form and no licence.
    """
    found = document_keys(docs, scan(F.col("text").cast("string")).alias("found"))
    rows = materialise(found.select("doc_id", "h", "found.digest", "found.lines"), "licence-digests")
    known = known_licences(docs.sparkSession)
    noticed = (
        rows.select("doc_id", "h", F.explode("lines").alias("digest"))
        .join(F.broadcast(known), "digest")
        .groupBy("doc_id", "h")
        .agg(F.array_sort(F.collect_set("licence")).alias("notices"))
    )
    found = rows.join(F.broadcast(known), "digest", "left").select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "digest", "licence"
    )
    same = found["_id"].eqNullSafe(noticed["doc_id"]) & (found["_h"] == noticed["h"])
    none = F.expr("cast(array() as array<string>)")
    return found.join(noticed, same, "left").select(
        F.col("_id").alias("doc_id"), "digest", "licence", F.coalesce("notices", none).alias("notices")
    )
