"""Tables and figures: which elements describe them, their summaries, and these written back into the elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.functions.text import row_prose, split_words
from docprep.session import never_sent

#: What a summary says when its model failed or gave nothing.
ERROR_SUMMARY = "Error generating summary."
EMPTY_SUMMARY = "Summary could not be generated."


def media_roots(elements: DataFrame) -> DataFrame:
    """(doc_id, filePaths, general_path, object_id_file, ord): one row for each list of files; the last element with it counts, the order is of the first."""
    with_files = elements.where(F.col("filePaths").isNotNull())
    return with_files.groupBy("doc_id", "filePaths").agg(F.max_by("Path", "pos").alias("p"), F.max_by("ObjectID", "pos").alias("object_id_file"), F.min("pos").alias("ord")).select(
        "doc_id", "filePaths", F.concat("p", F.lit("/")).alias("general_path"), "object_id_file", "ord"
    )


def _ancestors(path: Column) -> Column:
    """'a/b/c' -> ['a/', 'a/b/', 'a/b/c/']: every path the element lies at or under."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))


def media_inventory(elements: DataFrame) -> DataFrame:
    """(doc_id, files, object_id_file, general_path, specific_paths, texts, object_ids_text, ord): each list of files and the texts at or under its path.

    The path test is an equality: a text element is joined by each of its ancestors, so no two elements are compared by prefix.
    """
    roots = media_roots(elements)
    written = elements.where(F.col("Text").isNotNull()).select("doc_id", "pos", "Path", "Text", "ObjectID", F.explode(_ancestors(F.col("Path"))).alias("general_path"))
    paths = roots.select("doc_id", "general_path").distinct()
    under = written.join(paths, ["doc_id", "general_path"]).groupBy("doc_id", "general_path").agg(F.array_sort(F.collect_list(F.struct("pos", "Path", "Text", "ObjectID"))).alias("t"))
    joined = roots.join(never_sent(under), ["doc_id", "general_path"], "left")
    text, number = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    return joined.select(
        "doc_id",
        F.array_join("filePaths", ", ").alias("files"),
        "object_id_file",
        "general_path",
        F.coalesce("t.Path", text).alias("specific_paths"),
        F.coalesce("t.Text", text).alias("texts"),
        F.coalesce("t.ObjectID", number).alias("object_ids_text"),
        "ord",
    )


#: Characters at the end of a file name that rows meet by: the most that the name has.
_TAILS = (8, 4, 2, 1, 0)


def _tails(files: Column) -> Column:
    """What the end of a name that is part of one of the files can be: all pieces of these lengths."""
    pieces = lambda f, n: F.when(F.length(f) >= n, F.transform(F.sequence(F.lit(1), F.length(f) - n + 1), lambda i: F.substring(f, i, F.lit(n))))
    of = lambda f: F.flatten(F.filter(F.array(*(pieces(f, n) for n in _TAILS if n)), lambda x: x.isNotNull()))
    return F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(F.transform(F.split(files, ", "), of))))


def _tail(name: Column) -> Column:
    n = F.length(name)
    length = F.coalesce(*(F.when(n >= k, F.lit(k)) for k in _TAILS))
    return F.substring(name, n - length + 1, length)


def _matching_summaries(sheet: DataFrame, summaries: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, found): the summaries whose file name is part of one of the row's files, in their order.

    Rows meet by document and the end of the name, an equality with the pieces of the files; the substring test is left
    for them. So a document with a tenth of all files is no hot key and its files aren't all compared.
    """
    one_of = F.exists(F.split("files", ", "), lambda f: f.contains(F.col("_name")))
    named = summaries.select(F.col("doc_id"), F.col(name).alias("_name"), F.col("ord").alias("_ord"), F.col("summary").alias("_summary"))
    named = named.groupBy("doc_id", "_name", "_ord", "_summary").agg(F.count("*").cast("int").alias("_times"))
    ends = named.withColumn("_end", _tail(F.col("_name")))
    pieces = sheet.select("doc_id", *keys, "files").distinct().withColumn("_end", F.explode(_tails(F.col("files"))))
    met = pieces.join(ends, ["doc_id", "_end"]).where(one_of)
    each = F.struct("_ord", "_name", "_summary", "_times")
    found = met.groupBy("doc_id", *keys).agg(F.array_sort(F.collect_list(each)).alias("found"))
    return found.withColumn("found", F.flatten(F.transform("found", lambda x: F.array_repeat(x, x["_times"]))))


def merge_summaries(sheet: DataFrame, summaries: DataFrame, keys: tuple[str, ...] = ("ord",), name: str = "file_name") -> DataFrame:
    """The sheet with summaries appended, line by line, of every file whose name is part of one of the row's files.

    Both have doc_id; sheet has files and summary, summaries has a name, ord and summary. Null summaries add nothing.
    """
    found = _matching_summaries(sheet, summaries.where(F.col("summary").isNotNull()), list(keys), name)
    joined = sheet.join(never_sent(found), ["doc_id", *keys], "left")
    lines = F.concat(F.when(F.col("summary").isNotNull(), F.array("summary")).otherwise(F.array().cast("array<string>")), F.coalesce(F.col("found._summary"), F.array().cast("array<string>")))
    return joined.withColumn("summary", F.when(F.size(lines) > 0, F.array_join(lines, "\n"))).drop("found")


def fill_summaries(sheet: DataFrame, summaries: DataFrame, keys: tuple[str, ...] = ("ord",), name: str = "image_name") -> DataFrame:
    """As merge_summaries, for rows whose summary is null or the error text only: they take summaries as long as that holds."""
    found = _matching_summaries(sheet, summaries.where(F.col("summary").isNotNull()), list(keys), name)
    joined = sheet.join(never_sent(found), ["doc_id", *keys], "left")
    old = F.when(F.col("summary").isNotNull(), F.array("summary")).otherwise(F.array().cast("array<string>"))
    seq = F.concat(old, F.coalesce(F.col("found._summary"), F.array().cast("array<string>")))
    taken = F.when(F.size(seq) == 0, F.lit(None)).when(seq[0] != ERROR_SUMMARY, seq[0]).otherwise(F.array_join(F.slice(seq, 1, 2), "\n"))
    openly = F.col("summary").isNull() | (F.col("summary") == ERROR_SUMMARY)
    return joined.withColumn("summary", F.when(openly, taken).otherwise(F.col("summary"))).drop("found")


def write_back(elements: DataFrame, sheet: DataFrame, match: str = "substring") -> DataFrame:
    """The elements with the sheet's summaries as their text, and the texts the summaries replace emptied.

    An element with files and a row's object id takes that row's summary, null too; the last row counts. One without
    files whose path is among a row's specific paths gets ''. With match='substring' a path that is part of a listed
    path is among them, with 'exact' only an equal one. Paths begin with //.
    """
    rows = sheet.select("doc_id", "object_id_file", "summary", "specific_paths", "ord")
    summary = rows.groupBy("doc_id", F.col("object_id_file").alias("ObjectID")).agg(F.max_by(F.struct(F.col("summary").alias("s")), "ord").alias("new"))
    listed = rows.select("doc_id", F.explode("specific_paths").alias("listed")).distinct()
    if match == "exact":
        emptied = listed.select("doc_id", F.col("listed").alias("Path"))
    else:
        bare = elements.where(F.col("filePaths").isNull()).select("doc_id", "Path").distinct()
        # paths begin with //, so what is part of a listed path is a start of its rest from some //
        at = F.filter(F.sequence(F.lit(1), F.length("listed")), lambda i: F.substring("listed", i, F.lit(2)) == "//")
        tails = listed.select("doc_id", F.explode(F.transform(at, lambda i: F.substring("listed", i, F.length("listed")))).alias("tail")).distinct()
        pieces = tails.select("doc_id", F.explode(F.transform(F.sequence(F.lit(2), F.length("tail")), lambda n: F.substring("tail", F.lit(1), n))).alias("Path")).distinct()
        emptied = bare.join(pieces, ["doc_id", "Path"], "left_semi")
    emptied = emptied.distinct().withColumn("_empty", F.lit(True))
    joined = elements.join(summary, ["doc_id", "ObjectID"], "left").join(emptied, ["doc_id", "Path"], "left")
    with_files = F.col("filePaths").isNotNull()
    text = F.when(with_files & F.col("new").isNotNull(), F.col("new.s")).when(~with_files & F.col("_empty"), F.lit("")).otherwise(F.col("Text"))
    return joined.withColumn("Text", text).select(elements.columns)


def table_prose(rows: DataFrame, key: list[str], order: str, columns: list[str]) -> DataFrame:
    """(key, summary): every row of a table as prose, a line each, numbered from 1 in order."""
    numbered = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), *(F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns))))).alias("r"))
    lines = F.transform("r", lambda r, i: row_prose(i + 1, [(c, r[f"v{j}"]) for j, c in enumerate(columns)]))
    return numbered.select(*key, F.array_join(lines, "\n").alias("summary"))


#: Most words of a vocabulary that is sent to every task; a larger one is joined.
MOST_WORDS = 200_000


def word_validity(texts: DataFrame, id: str, text: str, vocabulary: DataFrame, word: str = "word", threshold: float = 0.9) -> DataFrame:
    """(id, n_words, n_valid, is_gibberish): words of more than two characters, and those the vocabulary knows in lower case.

    Gibberish is a text with fewer valid words than the threshold's share; one without words isn't. A vocabulary of at
    most MOST_WORDS words goes to the texts, whose words then are counted where they are; with a larger one each word of
    a text is sent once to meet it. Null words are none; a null text has no words; repeated rows each come out.
    """
    known = vocabulary.select(F.col(word).cast("string").alias("w")).where("w is not null").distinct().withColumn("valid", F.lit(1))
    words = texts.select(F.col(id).alias("id"), F.explode(F.filter(split_words(F.col(text)), lambda w: F.length(w) > 2)).alias("w"))
    words = words.select("id", F.lower("w").alias("w"))
    if known.limit(MOST_WORDS + 1).count() <= MOST_WORDS:
        met = words.withColumn("n", F.lit(1)).join(F.broadcast(known), "w", "left")
    else:
        met = words.groupBy("id", "w").agg(F.count("*").alias("n")).join(known, "w", "left")
    sums = met.groupBy("id").agg(F.sum("n").alias("n_words"), F.sum(F.col("n") * F.coalesce("valid", F.lit(0))).alias("n_valid"))
    joined = texts.select(F.col(id).alias("id")).join(sums, "id", "left").na.fill(0, ["n_words", "n_valid"])
    # a repeated id sums over its rows
    return joined.select(F.col("id").alias(id), "n_words", "n_valid", (F.col("n_valid") < F.col("n_words") * F.lit(threshold)).alias("is_gibberish"))
