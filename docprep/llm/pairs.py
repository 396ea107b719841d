"""Broken prompt and response pairs, each with its type of defect.

One pass over the rows looks for the defects that a row shows by itself: an empty answer, a copy of the
question, another language, a break inside a sentence that the contexts carry on. Refusals show across rows: the
openings of all answers, each without the words taken from its own question, are clustered by verified MinHash over
their characters, in any script. A template that says nothing of its own, recurs across unrelated prompts and isn't
supported by their contexts reveals them; no list of words decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docprep.llm.components import components
from docprep.llm.language import Languages, fit
from docprep.llm.neardup import sketch
from docprep.llm.sketch import character_shingles, paired_jaccard
from docprep.session import cut, never_sent

_WORD = re.compile(r"\w+")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
_PART = re.compile(r"[぀-ヿ㐀-鿿가-힯]|[^぀-ヿ㐀-鿿가-힯]+")
_LABEL = re.compile(r"^[\W_]*(?:answer|response|reply|a)\s*:[\W_]*", re.I)
_ENDS = ".!?。！？"
_CLOSERS = "\"'”’)]*»"
_ABBREVIATION = re.compile(r"\b(?:e\.g|i\.e|cf|vs|approx|fig|dr|mr|mrs|st|resp|incl)\.$", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s|(?<=[。！？])|[\r\n]+")
_BEGINS = re.compile(r"[.!?。！？][\"'”’)*\]»]* ")
_LINES = re.compile(r"[\r\n]+")
_INTERJECTION = re.compile(r"^\W*(?:(?:[\w'’]+\s+){0,2}[\w'’]+\s*(?:,|:|-|–|—)\s*(?:but\s+)?|(?:unfortunately|regrettably|sadly|sorry|apologies)\s+)", re.I)

#: What stands where an answer is missing.
PLACEHOLDERS = {"n/a", "na", "none", "null", "nan", "nil", "blank", "tbd", "tba", "empty", "undefined", "no answer", "missing", "unknown", "pending", "todo"}
#: Signs of inability, which tell a refusal of two or three words from other answers that are no sentence.
SHORT_SIGNS = re.compile(r"\b(?:cannot|can ?not|can['’]?t|unable|sorry|no comment|declined?|refused?|won['’]?t)\b|抱歉|无法|对不起", re.I)
#: Words, or two characters of a script without spaces each, from which on an opening counts as a sentence.
CLAUSE = 4
#: Runs of so many characters are an opening's shingles, which weigh the less the later they come; openings so similar are one template.
RUN, SIMILARITY = 3, 0.45

_CHECKED = "id bigint, defect string, template string, lead string, bare boolean, supported boolean, prompt string"


def tokens(text: str | None) -> list[str]:
    """Lower-cased words; characters of scripts written without spaces each count as one."""
    found = _WORD.findall((text or "").lower())
    if not text or text.isascii() or not _WIDE.search(text):
        return found
    return [x for w in found for x in (_PART.findall(w) if _WIDE.search(w) else (w,))]


def asked_for(words: list[str]) -> str:
    """What tells two prompts apart: the longer words, and each character of a script without spaces with what follows it."""
    return " ".join(dict.fromkeys(w + v if _WIDE.match(w) else w for w, v in zip(words, [*words[1:], ""]) if len(w) > 3 or _WIDE.match(w)))


def is_empty(answer: str | None) -> bool:
    """Nothing is left without labels and marks, or only a placeholder."""
    if answer is None:
        return True
    rest = answer
    while (m := _LABEL.match(rest)) and m.end():
        rest = rest[m.end() :]
    said = re.sub(r"[^\w/]+|_", " ", rest).strip(" /").lower()
    return not any(c.isalnum() for c in said) or said in PLACEHOLDERS


def is_copy(question: str | None, answer: str, least: float = 0.75) -> bool:
    """Most pairs of neighbouring words come from the question, and nothing new follows it."""
    return _copies(tokens(question), tokens(answer), answer, least)


def _copies(asked: list[str], given: list[str], answer: str, least: float = 0.75) -> bool:
    pairs = list(zip(given, given[1:]))
    known = set(zip(asked, asked[1:]))
    if len(pairs) < 2 or sum(p in known for p in pairs) < least * len(pairs):
        return False
    after = re.split(r"[?？]|[\"”],", answer)[-1]
    new = [w for w in tokens(after) if w not in asked and w not in ("answer", "question")]
    return len(after) == len(answer) or not new


def lined(text: str | None) -> tuple[str, set[int]]:
    """The text with single spaces, and the positions in it where a line ends."""
    lines = [s for s in (" ".join(x.split()) for x in _LINES.split(text or "")) if s]
    at, ends = 0, set()
    for x in lines:
        ends.add(at + len(x))
        at += len(x) + 1
    return " ".join(lines), ends


def _closes(text: str, at: int, line_ends: set[int]) -> bool:
    """A sentence or line ends at the position."""
    if at >= len(text) or at in line_ends:
        return True
    head = text[max(0, at - 12) : at].rstrip(_CLOSERS)
    return bool(head) and head[-1] in _ENDS and (text[at] == " " or head[-1] in "。！？") and not _ABBREVIATION.search(head)


def is_truncated(answer: str, contexts: str | tuple[str, set[int]] | None) -> bool:
    """The answer ends inside a sentence or list item that it began and the contexts, lined already or not, carry on.

    Its end is looked up in the contexts; where every place goes on, and the text shared up to there holds the
    start of the sentence or line, the answer broke off. An end that matches inside a sentence only, like a bare
    dose, is a short answer.
    """
    said = " ".join(answer.split()).rstrip("*").strip()
    rest = said
    if marked := said.endswith(("…", "...")):
        rest = said.removesuffix("…") if said.endswith("…") else said[:-3]
    elif marked := said.endswith("-") and bool(_WORD.match(said[-2:-1])):
        rest = said[:-1]
    rest = rest.strip()
    text, line_ends = contexts if isinstance(contexts, tuple) else lined(contexts)
    if not rest or not text:
        return False
    places: list[int] = []
    for k in (200, 60, 25, 12):
        tail = rest[-k:]
        at = text.find(tail)
        while at >= 0:
            places.append(at + len(tail))
            at = text.find(tail, at + len(tail))
        if places:
            break
    if not places:  # a last sentence that doesn't follow the one before it in the contexts
        begun = [m for m in _BEGINS.finditer(rest) if not _ABBREVIATION.search(rest[: m.start() + 1])]
        last = rest[begun[-1].end() :] if begun else ""
        at = text.find(last) if len(last) > 2 else -1
        while at >= 0:
            if (at == 0 or _closes(text, at - 1, line_ends)) and not _closes(text, at + len(last), line_ends):
                return True
            at = text.find(last, at + 1)
    broke = False
    for at in places:
        if not marked and _closes(text, at, line_ends):
            return False
        shared = 0
        while shared < min(len(rest), at) and rest[-1 - shared] == text[at - 1 - shared]:
            shared += 1
        broke |= any(s == 0 or _closes(text, s - 1, line_ends) for s in range(at - shared, at))
    return broke


def opening(answer: str) -> tuple[list[str], str, str]:
    """(words, sentence, lead): the first sentence, its words without an interjection before them, and that interjection."""
    said = _LABEL.sub("", answer).strip()
    sentence = next((s for s in _SENTENCE.split(said) if s and s.strip()), said).strip()
    m = _INTERJECTION.match(sentence)
    lead = " ".join(tokens(m.group())) if m else ""
    return _WORD.findall(sentence[m.end() :].lower() if m else sentence.lower()), sentence, lead


def masked(words: list[str], question: list[str], least: int = 3, long: int = 7) -> list[str]:
    """The template of an opening: its words without the long ones that its own question asks about.

    What a template says about the topic at hand thereby falls away, and numbers are all alike. Other rows have no
    part in it. An opening of which fewer than `least` words would be left keeps its own words.
    """
    asked = {w for w in question if len(w) >= long}
    kept = [w for w in words if w not in asked]
    return ["0" if w.isdigit() else w for w in (kept if len(kept) >= least else words)]


def is_supported(sentence: str, given: list[str], text: str, least: float = 0.3) -> bool:
    """The sentence stands in the contexts' text (see lined), or so much of the runs of three of the answer's words does."""
    if " ".join(sentence.split()).rstrip(_ENDS) in text:
        return True
    there = tokens(text)
    known = set(zip(there, there[1:], there[2:]))
    runs = list(zip(given, given[1:], given[2:]))
    return bool(runs) and sum(r in known for r in runs) >= least * len(runs)


def is_clause(sentence: str, words: list[str]) -> bool:
    """The opening is a sentence, or a shorter one with a sign of inability."""
    size = sum(0.5 if _WIDE.match(w) else 1 for w in words)
    return size >= CLAUSE or size >= 1 and bool(SHORT_SIGNS.search(sentence))


def check_rows(rows: DataFrame, id: str, question: str, answer: str, contexts: str, languages: Languages) -> DataFrame:
    """(id, defect, template, lead, bare, supported, prompt): what a row shows by itself.

    template is the opening's, if it is a sentence, lead the interjection before it; bare tells that it has no digit, supported that the contexts hold it.
    """
    # some twenty languages of 128 kB each; plain values, as the class travels with the function
    shared = rows.sparkSession.sparkContext.broadcast((languages.names, languages.table, languages.seen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Languages(*shared.value)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            ids, asked, given, shown = (column.to_pylist() for column in batch.columns)
            other = models.differ(asked, given)
            for key, q, a, c, foreign in zip(ids, asked, given, shown, other):
                defect = template = lead = prompt = None
                bare, supported = False, True
                if is_empty(a):
                    defect = "empty"
                elif _copies(asked_words := tokens(q), words := tokens(a), a):
                    defect = "copy"
                elif foreign:
                    defect = "language"
                elif is_truncated(a, text := lined(c)):
                    defect = "truncated"
                else:
                    start, sentence, before = opening(a)
                    if is_clause(sentence, first := tokens(" ".join(start))):
                        template, lead = " ".join(masked(first, asked_words)), before or None
                        bare = not any(ch.isdigit() for ch in sentence)
                        supported = is_supported(sentence, words, text[0])
                        prompt = asked_for(asked_words) if bare and not supported else None
                for column, value in zip(out, (key, defect, template, lead, bare, supported, prompt)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string()))],
                names=["id", "defect", "template", "lead", "bare", "supported", "prompt"],
            )

    taken = rows.select(F.col(id).cast("bigint").alias("id"), *(F.col(c).cast("string") for c in (question, answer, contexts)))
    return taken.where("id is not null").mapInArrow(run, _CHECKED)


def unlike(prompts: DataFrame, one: str, two: str, least: float = 0.7) -> DataFrame:
    """The rows of which two prompts (see asked_for) share less than so much: neither is the other written again."""
    a, b = F.split(one, " "), F.split(two, " ")
    return prompts.where(F.size(F.array_intersect(a, b)) < least * F.size(F.array_union(a, b)))


def bucketed(templates: DataFrame, similarity: float) -> DataFrame:
    """(id, key): the buckets in which templates (id, template) meet."""
    return cut(sketch(templates, "id", F.col("template"), RUN, similarity, 1, "opening", "character").select("id", F.explode("bands").alias("key")))


def alike(pairs: DataFrame, one: DataFrame, two: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the pairs (a, b) whose templates (id, template), a's in one and b's in two, are similar enough.

    Texts travel with the pairs, as they are much smaller than their shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.chunked_array([batch.column(2), batch.column(3)]).combine_chunks().dictionary_encode()
            at = texts.indices.to_numpy()
            sets = character_shingles(texts.dictionary.to_pylist(), RUN)
            found = paired_jaccard(sets, "opening", len(texts.dictionary), at[: batch.num_rows], at[batch.num_rows :])
            yield batch.select([0, 1]).filter(pa.array(found >= similarity))

    texts = [t.select(F.col("id").alias(x), F.col("template").alias(f"text_{x}")) for t, x in ((one, "a"), (two, "b"))]
    both = pairs.join(never_sent(texts[0]), "a").join(never_sent(texts[1]), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def clusters(templates: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, group_id): templates (id, template) linked by verified MinHash over their characters.

    A bucket's members are first compared with its least one, which groups most variants of a template without pairing
    them. Then all members of a bucket that are still in different groups are compared with each other, so the groups
    are those of all similar pairs that meet.
    """
    keys = bucketed(templates, similarity)
    least = keys.groupBy("key").agg(F.min("id").alias("a"))
    first = keys.join(never_sent(least), "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    found = components(alike(first, templates, templates, similarity), "a", "b").toDF("id", "component")
    placed = cut(keys.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("group_id")))
    groups = placed.select("key", "group_id").distinct()
    across = groups.toDF("key", "g").join(groups.toDF("key", "h"), "key").where("g < h")
    rest = across.join(placed.toDF("key", "a", "g"), ["key", "g"]).join(placed.toDF("key", "b", "h"), ["key", "h"]).select("a", "b").distinct()
    links = placed.select(F.col("group_id").alias("a"), F.col("id").alias("b")).distinct().unionByName(alike(rest, templates, templates, similarity))
    found = components(links, "a", "b").toDF("id", "component")
    return templates.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("group_id"))


def backed_by(suspects: DataFrame, others: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(group_id, id), distinct: the templates of others (id, template) that are similar to one of suspects (id, template, group_id).

    In a bucket one member of each group is first compared with the others, then all members are compared with those
    that no comparison has tied to the group.
    """
    of = suspects.select(F.col("id").alias("a"), "group_id")
    one, two = bucketed(suspects, similarity).toDF("a", "key").join(of, "a").select("key", "group_id", "a"), bucketed(others, similarity).toDF("b", "key")
    tied = lambda pairs: alike(pairs.distinct(), suspects, others, similarity).join(of, "a").select("group_id", "b").distinct()
    least = one.groupBy("key", "group_id").agg(F.min("a").alias("a"))
    known = cut(tied(two.join(never_sent(least), "key").select("a", "b")))
    open = two.join(never_sent(least.select("key", "group_id")), "key").join(known, ["group_id", "b"], "left_anti")
    rest = tied(open.join(never_sent(one), ["key", "group_id"]).select("a", "b"))
    return known.unionByName(rest).withColumnRenamed("b", "id")


def openings(checked: DataFrame) -> DataFrame:
    """(id, template, bare, supported, prompt): a row for each row's template and, if it is bare, one for its lead; id is the text's hash."""
    said = checked.where("template is not null").select(F.explode(F.array_compact(F.array("template", F.when(F.col("bare"), F.col("lead"))))).alias("template"), "bare", "supported", "prompt")
    return said.withColumn("id", F.xxhash64("template"))


def refusal_templates(every: DataFrame, similarity: float = SIMILARITY, unsupported: float = 0.8) -> DataFrame:
    """(id): the templates and leads (see openings) of clusters that recur across unrelated prompts without support.

    The bare openings of rows without support are clustered over their whole sentence, so that an edited word leaves
    an opening in its cluster. Bare openings of supported rows speak against a similar cluster, and only meet those
    that recur. Openings with digits join a cluster that passes. Templates are counted before they are clustered, so
    one that is repeated in a third of all rows is one row here.
    """
    said = every.where("bare")
    lone = said.where("not supported").groupBy("id", "template").agg(F.count("*").alias("n"), F.min("prompt").alias("least"))
    lone = cut(lone)
    grouped = cut(lone.join(clusters(lone.select("id", "template"), similarity), "id"))
    lead = grouped.groupBy("group_id").agg(F.min("least").alias("lead"))
    # a cluster recurs if any of its rows' prompts is unlike its first one
    prompts = said.where("not supported").select("id", "prompt").distinct().join(grouped.select("id", "group_id"), "id").join(lead, "group_id")
    recurring = unlike(prompts, "prompt", "lead").select("group_id").distinct()
    suspects = cut(grouped.join(recurring, "group_id", "left_semi"))
    backed = cut(said.where("supported").groupBy("id", "template").agg(F.count("*").alias("n")))
    against = backed_by(suspects.select("id", "template", "group_id"), backed.select("id", "template"), similarity).join(backed, "id").groupBy("group_id").agg(F.sum("n").alias("against"))
    counts = suspects.groupBy("group_id").agg(F.sum("n").alias("n")).join(against, "group_id", "left")
    kept = counts.where(F.col("n") >= unsupported * (F.col("n") + F.coalesce("against", F.lit(0)))).select("group_id")
    refusals = cut(suspects.join(kept, "group_id", "left_semi").select("id", "template", "group_id"))
    numbered = every.where("not bare and not supported").select("id", "template").distinct()
    joined = numbered.join(backed_by(refusals, numbered, similarity).select("id").distinct(), "id", "left_semi")
    return refusals.select("id").unionByName(joined.select("id")).distinct()


def broken_pairs(rows: DataFrame, id: str = "qa_id", question: str = "question", answer: str = "answer", contexts: str = "contexts", languages: Languages | None = None) -> DataFrame:
    """(id, defect) of each defective row: 'empty', 'copy', 'language', 'truncated' or 'refusal', the first that holds.

    A null answer is empty; a null question has no language and can't be copied; null contexts carry nothing on.
    languages are models fitted on labelled texts; without them those of the fixed first texts serve, which know less.
    Repeated rows each come out. A null id is left out. Columns other than those named are not read, so clashing
    names don't matter. An empty table gives an empty result. Whole texts are read.
    """
    checked = cut(check_rows(rows, id, question, answer, contexts, languages or fit([], [])))
    signs = cut(refusal_templates(openings(checked)))
    lone = checked.where("not supported and template is not null")
    for column, of in (("template", F.col("template")), ("lead", F.when(F.col("bare"), F.col("lead")))):
        sign = signs.select(F.col("id").alias(f"_{column}"), F.lit(True).alias(f"by_{column}"))
        lone = lone.withColumn(f"_{column}", F.xxhash64(of)).join(sign, f"_{column}", "left")
    refused = lone.where(F.coalesce("by_template", "by_lead", F.lit(False)))
    found = checked.where("defect is not null").select("id", "defect")
    return found.unionByName(refused.select("id", F.lit("refusal").alias("defect"))).withColumnRenamed("id", id)
