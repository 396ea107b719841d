"""Visually identical text with different characters, brought to one consistent form.

Texts that may hold such characters are mapped to their look-alike form; the forms are grouped in SQL under the
accent-sensitive Unicode collation, each class gets one deterministic member, and that is joined back. Texts
without any such character are their own form and never leave their partition. Which letters look alike is not listed
here: the confusables of the Unicode standard come from the ICU library that Spark ships for its collations.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docprep.session import cut, never_sent

#: The ranges of letters that confusables are looked for in, phonetic notation but no orthography of Latin letters among them.
_LETTER_RANGES = ((0x250, 0x2B0), (0x370, 0x1100), (0x1200, 0x1E00), (0x1F00, 0x2000), (0x2C80, 0x3000), (0xA4D0, 0xA700), (0xA720, 0xAC00), (0x10000, 0x12000), (0x16800, 0x17000))
#: Letters whose skeleton is another letter than the Latin one they look like.
ALSO = {ord("ӏ"): "l", ord("յ"): "j", ord("Ԛ"): "Q"}
_SMALL_CAPITAL = re.compile("LATIN (?:LETTER SMALL CAPITAL ([A-Z])|SMALL LETTER KRA)$")
_GREEK = re.compile("[Ͱ-Ͽ]")
#: Ranges of characters, as the inside of a character class that Java and Python read alike.
FULL_WIDTH = "！-～"
LIGATURES = "ﬀ-ﬆĲĳǄ-ǌǱ-ǳ"
UNIT_SIGNS = "ΩKÅ"
ACCENTS = "̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯"
SPACES = "   -   　"
SELECTORS = "︀-️"
JOINER = "‍"
UNSEEN = "\u0000-\u0008\u000e-\u001f\u007f-\u0084\u0086-\u009f­؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯⠀ㅤ﻿ﾠ￹-￻" + SELECTORS
UNSEEN_HIGH = "\U0001d173-\U0001d17a\U000e0001\U000e0020-\U000e007f\U000e0100-\U000e01ef"
#: Characters that the canonical composition replaces though they look the same.
SINGLETONS = "̀́ʹ;·ά-ώι`´〈〉ᄀ-ᇿ豈-﫿"
LATIN = "A-Za-zªºÀ-ÖØ-öø-ʯᴀ-ᶿḀ-ỿⱠ-ⱿꜢ-ꟿꬰ-ꭤ" + LIGATURES + "Ａ-Ｚａ-ｚ"

#: Ranges of pictures, and signs that a selector shows as one.
PICTURES = "\u2190-\u21ff\u2300-\u23ff\u24c2\u25a0-\u27bf\u2900-\u297f\u2b00-\u2bff\u3030\u303d\u3297\u3299\U0001f000-\U0001faff"
SIGNS = "\u00a9\u00ae\u203c\u2049\u2122\u2139"
_PICTURE, _SELECTOR = re.compile(f"[{PICTURES}]"), re.compile(f"[{SELECTORS}]")
_PLAIN_CASE = re.compile(f"[{FULL_WIDTH}{LIGATURES}{UNIT_SIGNS}{ACCENTS}{SPACES}]")
_UNSEEN = re.compile(f"[{UNSEEN}{UNSEEN_HIGH}]")
_LATIN = re.compile(f"[{LATIN}]")
_FOLD = {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {ord(c): " " for c in "    　"} | {c: " " for c in range(0x2000, 0x200B)}
#: Blocks of mathematical letters and letter-like signs, whose compatible letters replace them.
STYLED = "ℂ℃℉ℊ-ℓℕℙ-ℝℤℨℬ-ℭℯ-ℱℳℴℹⅅ-ⅉ" + "\U0001d400-\U0001d7cb"
_STYLED = re.compile(f"[{STYLED}]")
_FOLD |= {c: unicodedata.normalize("NFKC", chr(c)) for a, b in ((0xFB00, 0xFB06), (0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3)) for c in range(a, b + 1)}
_FOLDABLE = re.compile(f"[{FULL_WIDTH}{LIGATURES}{SPACES}]")


def confusables(spark: SparkSession) -> tuple[dict[int, str], dict[int, str]]:
    """(posing, near): letters over the Latin letter they look like, by ICU's skeletons of all letters.

    A letter poses if it belongs to another script that runs from left to right, or to phonetic notation, and its
    skeleton is one ASCII letter; a capital whose skeleton is l stands for I. It is near if its skeleton, or itself, is
    shaped like a small capital: such a letter poses only in a word that also holds a Latin one.
    """
    letters = [c for first, last in _LETTER_RANGES for c in range(first, last) if unicodedata.category(chr(c))[0] == "L" and unicodedata.bidirectional(chr(c)) == "L"]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    skeletons = checker.getSkeleton("\n".join(map(chr, letters))).split("\n")
    posing, near = {}, {}
    for c, skeleton in zip(letters, skeletons, strict=True):
        name = unicodedata.name(chr(c), "")
        if unicodedata.decomposition(chr(c)).startswith(("<font>", "<super>", "<sub>", "<wide>")):
            continue  # styled forms are folded, raised ones stay
        small = _SMALL_CAPITAL.match(unicodedata.name(skeleton, "")) if len(skeleton) == 1 else None
        if len(skeleton) == 1 and skeleton.isascii() and skeleton.isalpha():
            posing[c] = "I" if skeleton == "l" and ("CAPITAL" in name or name.startswith("LISU")) else skeleton
        elif small:
            near[c] = small.group(1).lower() if small.group(1) else "k"
    return posing | ALSO, near


@dataclass(frozen=True)
class LookAlikes:
    """The letters that pose as Latin ones, see confusables."""

    posing: dict[int, str]
    near: dict[int, str]

    @property
    def letters(self) -> str:
        """The letters as the inside of a character class; runs of them as ranges, which match faster."""
        runs: list[list[int]] = []
        for c in sorted(self.posing | self.near):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs)

    @property
    def suspect_pattern(self) -> str:
        """A Java pattern of the characters without which a text is its own consistent form.

        The look-ahead passes over ordinary ASCII before the long class is tried.
        """
        return rf"(?=[^\t-\r -~])[{FULL_WIDTH}{LIGATURES}{UNIT_SIGNS}{ACCENTS}{SPACES}{UNSEEN}{UNSEEN_HIGH}{SINGLETONS}{STYLED}{self.letters}]"

    def look_alike(self, text: str) -> tuple[str, bool]:
        """(the text mapped to plain characters, whether it holds a look-alike at all).

        Full-width forms, ligatures, unit signs and special spaces become ordinary characters; characters that print
        nothing go; accents join their letters where one character exists; posing letters become the Latin ones.
        Mathematical letters become plain ones too, but aren't look-alikes.
        """
        seen = _drop_unseen(text) if _UNSEEN.search(text) else text
        case = seen != text or bool(_PLAIN_CASE.search(text))
        plain = _FOLDABLE.sub(lambda m: _FOLD[ord(m.group())], seen)
        if _STYLED.search(plain):
            plain = _STYLED.sub(lambda m: unicodedata.normalize("NFKC", m.group()), plain)
        if not unicodedata.is_normalized("NFC", plain):
            plain = unicodedata.normalize("NFC", plain)
        if self._poser.search(plain):
            shown = self._unmask(plain)
            case |= shown != plain
            plain = shown
        return plain, case

    @cached_property
    def _poser(self) -> re.Pattern:
        return re.compile(f"[{self.letters}]")

    @cached_property
    def _both(self) -> dict[int, str]:
        return self.posing | self.near

    def _unmasked(self, word: str) -> str:
        """A word without posing letters, if all its letters are Latin or pose as such; a lone Greek letter stays."""
        if len(word) == 1 and _GREEK.match(word):
            return word
        others = [c for c in word if ord(c) not in self._both]
        if not all(map(_LATIN.match, others)):
            return word
        # near letters pose beside Latin ones only
        return word.translate(self._both) if others or all(ord(c) in self.posing for c in word) else word

    def _unmask(self, text: str) -> str:
        """The text with each posing word in Latin letters. Only words around a letter that can pose are looked at."""
        out, last = [], 0
        for m in self._poser.finditer(text):
            if m.start() < last:
                continue
            start, end = m.start(), m.end()
            while start > last and text[start - 1].isalpha():
                start -= 1
            while end < len(text) and text[end].isalpha():
                end += 1
            out += (text[last:start], self._unmasked(text[start:end]))
            last = end
        return "".join(out) + text[last:]


def _part_of_picture(text: str, at: int) -> bool:
    """A selector or tag that belongs to the picture before it, or a joiner between two pictures."""
    back = at - 1
    while back >= 0 and _UNSEEN.match(text[back]):
        back -= 1
    if back < 0:
        return False
    if _SELECTOR.match(text[at]):
        return bool(_PICTURE.match(text[back])) or text[back] in SIGNS
    if text[at] == JOINER:
        after = at + 1
        while after < len(text) and _UNSEEN.match(text[after]):
            after += 1
        return bool(_PICTURE.match(text[back])) and after < len(text) and bool(_PICTURE.match(text[after]))
    return "\U000e0020" <= text[at] <= "\U000e007f" and bool(_PICTURE.match(text[back]))


def _drop_unseen(text: str) -> str:
    kept, last = [], 0
    for m in _UNSEEN.finditer(text):
        if not _part_of_picture(text, m.start()):
            kept.append(text[last : m.start()])
            last = m.end()
    return "".join(kept) + text[last:]


def map_texts(rows: DataFrame, text: str, known: LookAlikes) -> DataFrame:
    """The rows with (mapped, is_case) of their text, which must not be null."""
    schema = T.StructType([*rows.schema.fields, T.StructField("mapped", T.StringType()), T.StructField("is_case", T.BooleanType())])
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [known.look_alike(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([m for m, _ in pairs], pa.string()), pa.array([c for _, c in pairs], pa.bool_())], names=[*batch.schema.names, "mapped", "is_case"]
            )

    return rows.mapInArrow(run, schema)


def consistent_form(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, form, is_case): every row's text in the one consistent form of its class.

    Texts are in a class if their look-alike forms are equal under the accent- and case-sensitive Unicode collation;
    the form is the class's shortest look-alike form, then the least in code points. is_case tells whether the text
    holds a look-alike character. A null text has a null form, '' has ''. Repeated rows each come out. Columns other
    than those named are not read. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    known = LookAlikes(*confusables(spark))
    named = rows.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(text).cast("string").alias("t"))
    suspect = F.coalesce(F.col("t").rlike(known.suspect_pattern), F.lit(False))
    ids = [f"k{i}" for i in range(len(keys))]
    # checkpointed, as the classes and the join both read it: the input is searched and mapped once
    mapped = cut(map_texts(named.where(suspect), "t", known).select(*ids, "is_case", "mapped", F.unhex(F.md5(F.encode("mapped", "utf-8"))).alias("m")))
    classes = spark.sql(
        """
        WITH member AS (SELECT m, any_value(mapped) AS mapped FROM {mapped} GROUP BY m)
        SELECT min(struct(length(mapped) AS size, mapped AS form)).form AS form, collect_list(m) AS members
        FROM member GROUP BY mapped COLLATE UNICODE
        """,
        mapped=mapped,
    ).select("form", F.explode("members").alias("m"))
    odd = mapped.select(*ids, "is_case", "m").join(never_sent(classes), "m").select(*ids, "form", "is_case")
    plain = named.where(~suspect).select(*ids, F.col("t").alias("form"), F.lit(False).alias("is_case"))
    return plain.unionByName(odd).select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), "form", "is_case")
