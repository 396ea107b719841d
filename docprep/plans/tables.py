"""Queries of the operators over whole tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.functions import scores
from docprep.functions.json_repair import reply_objects, statement_verdicts
from docprep.functions.splitter import SIZE
from docprep.functions.text import citation, speaks_of_source, split_words
from docprep.operators import chunks as C
from docprep.operators import media as M
from docprep.operators import metrics, qa
from docprep.operators import sections as S
from docprep.plans.pipeline import chunk_documents, classified
from docprep.profiles import Header, Profile
from docprep.session import cut, table, tune
from docprep.sources.files import unprocessed

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    tune(spark)
    return [table(spark, sf_dir, n) for n in names]


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(*_tables(spark, sf_dir, "elements", "guidelines"))


def _classified_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified elements checkpointed, for queries that join what comes of them."""
    return cut(_classified(spark, sf_dir))


def latest_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    (elements,) = _tables(spark, sf_dir, "elements")
    return S.latest_delivery(elements).select("doc_id", "pos", "Path", "Text", "ObjectID")


def section_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("doc_id", "pos", "cls", "page_no", "title_id", "section_id", "text_id", "table_id", "figure_id")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.titles(_classified(spark, sf_dir)).select("doc_id", "title_id", "title_name", "page", "ObjectID")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sections(_classified(spark, sf_dir)).select("doc_id", "section_id", "section_name", "page", "ObjectID", "is_exception")


def text_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.text_chunks(_classified(spark, sf_dir)).select("doc_id", "text_id", "section_id", "Path", "page", "add_element", "add_element_table")


def media_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir)
    listed = [S.media(rows, kind).select("doc_id", F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("media_id"), "Path", F.array_join("filePath", ", ").alias("files")) for kind in ("table", "figure")]
    return listed[0].unionByName(listed[1])


def section_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified_once(spark, sf_dir)
    whole = C.section_texts(S.text_chunks(rows), S.sections(rows))
    lists = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("text_id", "pages")}
    return whole.withColumns(lists)


def exception_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified_once(spark, sf_dir)
    return C.exception_chunks(S.text_chunks(rows), S.sections(rows))


#: A family of documents with headings that become sections and exceptions at once.
HOUSE = Profile("house", title_has="/Title", stop="References", keep=("Key points", "Patient education", "Lifestyle advice"), headers=(Header(path_has="/H"),))


def _house(spark: SparkSession, sf_dir: str) -> DataFrame:
    (elements,) = _tables(spark, sf_dir, "elements")
    once = S.replace_signs(S.latest_delivery(elements)).withColumn("profile", F.lit(HOUSE.name))
    return cut(S.classify(once, "profile", {HOUSE.name: HOUSE}))


def kept_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sections(_house(spark, sf_dir)).where("is_exception").select("doc_id", "section_id", "section_name", "page", "ObjectID")


def kept_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _house(spark, sf_dir)
    return C.exception_chunks(S.text_chunks(rows), S.sections(rows))


def section_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified_once(spark, sf_dir)
    sheet = C.chunk_sheet(C.section_texts(S.text_chunks(rows), S.sections(rows)), S.titles(rows))
    return sheet.select("doc_id", "section_id", "section_name", "text_chunk", "Title")


def final_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_documents(*_tables(spark, sf_dir, "elements", "guidelines"), reuse=True)["final_chunks"]


def final_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each section's final chunks: its text where it is one, else that all keep the size and lie in it."""
    rows = _classified_once(spark, sf_dir)
    sets = chunk_documents(*_tables(spark, sf_dir, "elements", "guidelines"), rows=rows)
    whole = C.section_texts(S.text_chunks(rows), S.sections(rows)).select("doc_id", "section_id", F.col("text_chunk").alias("whole"))
    return _pieces_in(sets["final_chunks"].join(whole, ["doc_id", "section_id"]), ["doc_id", "section_id"])


def split_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (chunks,) = _tables(spark, sf_dir, "chunks_data")
    whole = chunks.where(F.col("text_chunk").isNotNull()).select("doc_id", "chunk_no", F.col("text_chunk").alias("whole")).distinct()
    return _pieces_in(C.split_sections(whole.withColumn("text_chunk", F.col("whole"))), ["doc_id", "chunk_no"])


def _pieces_in(pieces: DataFrame, keys: list[str]) -> DataFrame:
    size = F.length("text_chunk")
    checked = pieces.groupBy(*keys).agg(F.max("whole").alias("whole"), F.count("*").alias("n"), F.max(size).alias("most"), F.bool_and(F.col("whole").contains(F.col("text_chunk"))).alias("lies_within"), F.min("text_chunk").alias("one"))
    return checked.select(*keys, (F.length("whole") > SIZE).alias("was_cut"), F.when(F.length("whole") <= SIZE, F.when(F.col("n") == 1, F.col("one"))).alias("text"), (F.col("most") <= SIZE).alias("keeps_size"), "lies_within")


def split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (chunks,) = _tables(spark, sf_dir, "chunks_data")
    return C.split_sections(chunks.where(F.col("text_chunk").isNotNull()).select("doc_id", "chunk_no", "text_chunk"))


def signs_in_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    (elements,) = _tables(spark, sf_dir, "elements")
    return S.replace_signs(elements.select("doc_id", "pos", "Path", "Text", "Page"))


def media_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    (elements,) = _tables(spark, sf_dir, "elements")
    sheet = M.media_inventory(S.latest_delivery(elements))
    return sheet.select("doc_id", "files", "object_id_file", "general_path", F.array_join("specific_paths", "|").alias("specific_paths"), F.array_join("texts", "|").alias("texts"), F.array_join(F.col("object_ids_text").cast("array<string>"), "|").alias("object_ids_text"), "ord")


def _summaries(elements: DataFrame, kind: str, name: str) -> DataFrame:
    """Stand-ins for summaries: a line for each file of a kind, an error for object ids that end in 3."""
    files = elements.where(F.col("filePaths").isNotNull()).select("doc_id", "pos", "ObjectID", "Path", F.posexplode("filePaths").alias("i", "file"))
    base = F.regexp_extract("file", r"([^/]+)\.[^./]*$", 1)
    text = F.when(F.col("ObjectID") % 10 == 3, M.ERROR_SUMMARY).otherwise(F.concat(F.lit(f"{kind} at "), "Path"))
    return files.where(F.col("file").startswith(kind)).select("doc_id", base.alias(name), (F.col("pos") * 100 + F.col("i")).alias("ord"), text.alias("summary"))


def _sheet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    (elements,) = _tables(spark, sf_dir, "elements")
    once = cut(S.latest_delivery(elements))  # read by the inventory, the summaries and what is written back
    empty = M.media_inventory(once).withColumn("summary", F.lit(None).cast("string"))
    merged = M.merge_summaries(empty, _summaries(once, "tables", "file_name"), ("object_id_file", "ord"))
    return once, merged, M.fill_summaries(merged, _summaries(once, "figures", "image_name"), ("object_id_file", "ord"))


def substring_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheet(spark, sf_dir)[1].select("doc_id", "files", "ord", "summary")


def fallback_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheet(spark, sf_dir)[2].select("doc_id", "files", "ord", "summary")


def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    once, _, sheet = _sheet(spark, sf_dir)
    return M.write_back(once, sheet).select("doc_id", "pos", "ObjectID", "Text")


def row_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = _tables(spark, sf_dir, "part")
    return M.table_prose(part, ["p_brand"], "p_partkey", ["p_name", "p_type", "p_size"])


def word_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, guidelines = _tables(spark, sf_dir, "documents", "guidelines")
    vocabulary = guidelines.select(F.explode(split_words(F.lower("Title"))).alias("word"))
    return M.word_validity(documents, "doc_id", "text", vocabulary)


def usable_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (chunks,) = _tables(spark, sf_dir, "chunks_data")
    return qa.usable_chunks(chunks).select("doc_id", "chunk_no", "section_name", "text_chunk")


def chunk_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.slice_rows(usable_chunks(spark, sf_dir).dropDuplicates(["doc_id", "chunk_no"]), ["doc_id", "chunk_no"], 8, 10)


def qa_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs put into replies and taken out again."""
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    reply = F.concat(F.lit("**Question 1:** "), F.coalesce("question", F.lit("")), F.lit("\n**Answer:** "), F.coalesce("answer", F.lit("")))
    return rows.select("qa_id", F.explode(qa.qa_pairs(reply)).alias("p")).select("qa_id", "p.*")


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    return rows.select("qa_id", speaks_of_source(F.col("question")).alias("flag_source"), citation(F.col("Title"), F.col("section"), F.col("pages")).alias("reference_text"))


def _no_nan(c: str) -> Column:
    return F.when(~F.isnan(c), F.round(c, 6)).alias(c)


def _sentences(text: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\. "), lambda s: s != "")


def _found(sentence: Column, where: str) -> Column:
    return F.when(F.col(where).isNotNull(), F.when(F.col(where).contains(sentence), "1").otherwise("0"))


def faithfulness_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a stand-in that looks each sentence up in the contexts, as a model's reply."""
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    verdicts = F.transform(_sentences("answer"), lambda s: F.struct(s.alias("statement_1"), F.lit("looked up").alias("reason"), _found(s, "contexts").alias("verdict")))
    scored = metrics.faithfulness(rows.withColumn("verdict_replies", F.array(F.to_json(verdicts))), skip=F.col("Flag_Source") == 1)
    return scored.select("qa_id", _no_nan("faithfulness"))


def context_recall_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    flags = F.transform(_sentences("answer"), lambda s: F.struct(s.alias("statement_1"), _found(s, "full_text").alias("Attributed")))
    return metrics.context_recall(rows.withColumn("reply", F.to_json(flags))).select("qa_id", _no_nan("context_recall"))


def context_precision_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A context for each paragraph, useful if a sentence of the answer is in it."""
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    useful = lambda p: F.exists(_sentences("answer"), lambda s: p.contains(s))
    verdicts = F.transform(F.split("contexts", "\n\n"), lambda p: F.to_json(F.struct(F.lit("looked up").alias("reason"), F.when(useful(p), "1").otherwise("0").alias("verdict"))))
    scored = metrics.context_precision(rows.where(F.col("contexts").isNotNull()).withColumn("replies", verdicts))
    return scored.select("qa_id", _no_nan("context_precision"))


def correctness_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the answer against those of the reference."""
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), "[^a-z0-9]+"), lambda w: w != ""))
    a, r = words("answer"), words("contexts")
    lists = F.struct(F.array_intersect(a, r).alias("TP"), F.array_except(a, r).alias("FP"), F.array_except(r, a).alias("FN"))
    fenced = F.concat(F.lit("```json\n"), F.to_json(lists), F.lit("\n```"))
    vector = lambda c: F.array(F.length(F.coalesce(F.col(c), F.lit(""))).cast("double"), F.lit(100.0))  # noqa: E731 - stands for an embedding
    scored = metrics.answer_correctness(rows.withColumns({"reply": fenced, "truth_vector": vector("contexts"), "answer_vector": vector("answer")}))
    return scored.select("qa_id", _no_nan("statement_f1"), _no_nan("answer_correctness"))


def answer_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    (vectors,) = _tables(spark, sf_dir, "embeddings")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return vectors.join(after, "vec_id").select("vec_id", F.round(scores.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


def answer_relevancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the next two, which stand for those of generated questions; label 0 is noncommittal."""
    (vectors,) = _tables(spark, sf_dir, "embeddings")
    one, two = (vectors.select((F.col("vec_id") - k).alias("vec_id"), F.col("embedding").alias(f"v{k}")) for k in (1, 2))
    rows = vectors.join(one, "vec_id").join(two, "vec_id").withColumn("generated_vectors", F.array("v1", "v2"))
    reply = F.concat(F.lit('{"questions": ["a", "b"], "noncommittal": '), F.when(F.col("label") == 0, "1").otherwise("0"), F.lit("}"))
    scored = metrics.answer_relevancy(rows.withColumn("reply", reply), question_vector="embedding")
    return scored.select("vec_id", (_no_nan("answer_relevancy") + F.lit(0.0)).alias("answer_relevancy"))


def repaired_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two objects without a comma between them, as they come from a model, read as statements."""
    (rows,) = _tables(spark, sf_dir, "qa_rows")
    plain = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[^A-Za-z0-9 .]", " ")
    item = lambda n, c: F.concat(F.lit(f'{{"statement_{n}": "s '), plain(c), F.lit(f'", "reason": "r{n}", "verdict": "{n % 2}"}}'))
    reply = F.concat(F.lit("```json\n"), item(1, "question"), item(2, "section"), F.lit("\n```"))
    return rows.select("qa_id", F.explode(statement_verdicts(reply_objects(reply))).alias("s")).select("qa_id", "s.*")


def unprocessed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    guidelines, batches = _tables(spark, sf_dir, "guidelines", "structured_data")
    return unprocessed(guidelines.select("doc_id", "Title"), batches, "doc_id")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        latest_elements, section_assign, titles, sections, text_elements, media_elements, section_chunks, exception_chunks, kept_sections, kept_chunks, section_sheet, final_chunks, final_checks, split_chunks, split_checks,
        signs_in_words, media_inventory, substring_merge, fallback_merge, conditional_update, row_prose, word_validity, usable_chunks, chunk_slice, qa_extract, citations,
        faithfulness_score, context_recall_score, context_precision_score, correctness_f1, answer_similarity, answer_relevancy, repaired_replies, unprocessed_documents,
    )
}

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


#: Texts of the families of documents, written out for the SQL.
_ACE_NO_HEADER = """('Objective', 'Glycaemic control', 'Risk of adverse cardiorenal outcomes', 'Review parameters and frequency', 'Interdisciplinary care')"""
_ACE_KEEP = """('Recommendation  1 Assess the patient’s glycaemic control and risk of adverse cardiorenal outcomes.', 'Lifestyle intervention: a cornerstone of successful T2DM management', 'Insulin and T2DM', 'Patient involvement and education', 'Patient-centred care and shared decision-making', 'Recommendation 5: Adopt a patient-centred approach to make shared decisions on T2DM management.', 'Recommendation  6', 'Recognising poor adherence to diabetes medications in practice', 'Monitoring and follow-up')"""
_HEALTIERSG_KEEP = """('Recent key changes:')"""
_HEALTIERSG_HEADERS = """('Background ', 'Clinical Approach ')"""
_NUMBERING_KEEP = """('Scope of the guidelines', 'Algorithm for the management of breastfeeding', 'Summary of recommendations', 'Levels of Evidence and Grades of Recommendation', 'Key references', 'Acknowledgements', 'STATEMENT OF INTENT', 'FOREWORD', 'CONTENTS')"""
_SIGNS = lambda c: f"replace(replace({c}, '≥', 'more than or equals to'), '≤', 'less than or equals to')"
_H = {
    "ace": f"contains(Path, '/H1') AND Path <> '//Document/H1[9]/Figure' AND s NOT IN {_ACE_NO_HEADER}",
    "acg": "contains(Path, '/H1') AND s <> 'www.ace-hta.gov.sg'",
    "numbering": """(contains(Path, '/H') AND regexp_matches(Text, '^\\p{Nd}') AND Path NOT IN ('//Document/H1[8]', '//Document/H1[9]', '//Document/H1[10]', '//Document/Aside[4]/H1')
      OR NOT contains(Path, 'Span') AND regexp_matches(Text, '^\\p{Nd}+\\.\\p{Nd}'))""",
    "generic": "contains(Path, '/H')",
}
_ELEMENTS = f"""
WITH latest AS (
  SELECT * FROM elements QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY arrived_at DESC) = 1
), named AS (
  SELECT l.doc_id, l.pos, {_SIGNS('l.Path')} AS Path, {_SIGNS('l.Text')} AS Text, l.Page, l.ObjectID, l.filePaths,
    CASE WHEN lower(trim(g.profile)) IN ('ace', 'acg', 'healtiersg', 'numbering') THEN lower(trim(g.profile)) ELSE 'generic' END AS profile
  FROM latest l LEFT JOIN guidelines g USING (doc_id)
), stripped AS (
  SELECT *, regexp_replace(Text, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS s FROM named
), classed AS (
  SELECT *, CASE
    WHEN Text IS NULL AND regexp_matches(Path, '^//Document/Table(\\[[0-9]+\\])?$') THEN 'TABLE'
    WHEN Text IS NULL AND regexp_matches(Path, '^//Document/Figure(\\[[0-9]+\\])?$') THEN 'FIGURE'
    WHEN Text IS NULL THEN NULL
    WHEN profile = 'ace' THEN CASE WHEN Path = '//Document/Title/Sub[2]' THEN 'TITLE' WHEN s IN {_ACE_KEEP} THEN 'KEEP'
      WHEN {_H['ace']} THEN CASE WHEN s = 'References' THEN 'STOP' ELSE 'HEADER' END ELSE 'TEXT' END
    WHEN profile = 'acg' THEN CASE WHEN Path = '//Document/Figure' THEN 'TITLE'
      WHEN {_H['acg']} THEN CASE WHEN s = 'References' THEN 'STOP' ELSE 'HEADER' END ELSE 'TEXT' END
    WHEN profile = 'healtiersg' THEN CASE WHEN s IN {_HEALTIERSG_KEEP} THEN 'KEEP'
      WHEN contains(Path, '/H') AND contains(Text, '<') AND contains(Text, '>') OR starts_with(Text, '(<>)') THEN CASE WHEN s = '(<>)References' THEN 'STOP' ELSE 'HEADER' END
      WHEN s IN {_HEALTIERSG_HEADERS} THEN 'HEADER' ELSE 'TEXT' END
    WHEN profile = 'numbering' THEN CASE WHEN Path = '//Document/P[2]' THEN 'TITLE' WHEN s = 'References' THEN 'STOP' WHEN s IN {_NUMBERING_KEEP} THEN 'KEEP'
      WHEN {_H['numbering']} THEN 'HEADER' ELSE 'TEXT' END
    ELSE CASE WHEN contains(Path, '/Title') THEN 'TITLE' WHEN {_H['generic']} THEN CASE WHEN s = 'References' THEN 'STOP' ELSE 'HEADER' END ELSE 'TEXT' END
  END AS cls,
  Text IS NOT NULL AND CASE profile WHEN 'ace' THEN Path = '//Document/Title/Sub[2]' WHEN 'acg' THEN Path = '//Document/Figure' WHEN 'numbering' THEN Path = '//Document/P[2]' ELSE contains(Path, '/Title') END AS is_title
  FROM stripped
), counted AS (
  SELECT *, CAST(sum((cls IS NOT DISTINCT FROM 'STOP')::INT) OVER w AS INTEGER) AS stops, CAST(sum(is_title::INT) OVER w AS INTEGER) AS title_id,
    CAST(sum((coalesce(cls, '') IN ('KEEP', 'HEADER'))::INT) OVER w AS INTEGER) AS section_id, CAST(sum((cls IS NOT DISTINCT FROM 'TEXT')::INT) OVER w AS INTEGER) AS text_id,
    CAST(sum((cls IS NOT DISTINCT FROM 'TABLE')::INT) OVER w AS INTEGER) AS table_id, CAST(sum((cls IS NOT DISTINCT FROM 'FIGURE')::INT) OVER w AS INTEGER) AS figure_id, Page + 1 AS page_no
  FROM classed WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), kept AS (
  SELECT * FROM counted WHERE stops = 0 OR stops = 1 AND cls = 'STOP' AND is_title
), texts AS (
  SELECT doc_id, section_id, list(Text ORDER BY text_id) AS t, list(text_id ORDER BY text_id) AS ids, list_sort(list(DISTINCT page_no)) AS pages FROM kept WHERE cls = 'TEXT' GROUP BY ALL
), whole AS (
  SELECT k.doc_id, k.section_id, k.Text AS section_name, k.cls, ids, pages, t,
    CASE WHEN list_position(list_transform(t, lambda x: x <> ''), true) > 0 THEN array_to_string(t[list_position(list_transform(t, lambda x: x <> ''), true):], chr(10) || chr(10)) ELSE '' END AS text_chunk
  FROM kept k LEFT JOIN texts x USING (doc_id, section_id) WHERE k.cls IN ('KEEP', 'HEADER')
)
"""
_HOUSE = f"""
WITH named AS (
  SELECT doc_id, pos, {_SIGNS('Path')} AS Path, {_SIGNS('Text')} AS Text, Page + 1 AS page, ObjectID FROM elements
  QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY arrived_at DESC) = 1
), classed AS (
  SELECT *, CASE WHEN Text IS NULL THEN NULL WHEN contains(Path, '/Title') THEN 'TITLE'
    WHEN regexp_replace(Text, '^{_SPACE}+|{_SPACE}+$', '', 'g') IN ('Key points', 'Patient education', 'Lifestyle advice') THEN 'KEEP'
    WHEN contains(Path, '/H') THEN CASE WHEN regexp_replace(Text, '^{_SPACE}+|{_SPACE}+$', '', 'g') = 'References' THEN 'STOP' ELSE 'HEADER' END ELSE 'TEXT' END AS cls FROM named
), numbered AS (
  SELECT *, sum((cls IS NOT DISTINCT FROM 'STOP')::INT) OVER w AS stops, CAST(sum((coalesce(cls, '') IN ('KEEP', 'HEADER'))::INT) OVER w AS INTEGER) AS section_id
  FROM classed WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), kept AS (SELECT * FROM numbered WHERE stops = 0)
"""
_INVENTORY = """
WITH latest AS (
  SELECT * FROM elements QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY arrived_at DESC) = 1
), root AS (
  SELECT doc_id, filePaths, arg_max(Path, pos) || '/' AS general_path, arg_max(ObjectID, pos) AS object_id_file, min(pos) AS ord FROM latest WHERE filePaths IS NOT NULL GROUP BY ALL
), under AS (
  SELECT r.doc_id, r.filePaths, list(e.Path ORDER BY e.pos) AS p, list(e.Text ORDER BY e.pos) AS t, list(e.ObjectID ORDER BY e.pos) AS o
  FROM root r JOIN latest e ON e.doc_id = r.doc_id AND e.Text IS NOT NULL AND starts_with(e.Path || '/', r.general_path) GROUP BY ALL
), sheet AS (
  SELECT r.doc_id, array_to_string(r.filePaths, ', ') AS files, r.filePaths, r.object_id_file, r.general_path, r.ord, coalesce(p, []) AS p, coalesce(t, []) AS t, coalesce(o, []) AS o
  FROM root r LEFT JOIN under u ON u.doc_id = r.doc_id AND u.filePaths = r.filePaths
), file AS (
  SELECT doc_id, pos, ObjectID, Path, unnest(filePaths) AS file, generate_subscripts(filePaths, 1) - 1 AS i FROM latest WHERE filePaths IS NOT NULL
), said AS (
  SELECT doc_id, regexp_extract(file, '([^/]+)\\.[^./]*$', 1) AS name, pos * 100 + i AS n, split_part(file, '/', 1) AS kind,
    CASE WHEN ObjectID % 10 = 3 THEN 'Error generating summary.' ELSE split_part(file, '/', 1) || ' at ' || Path END AS summary FROM file
), met AS (
  SELECT s.doc_id, s.ord, kind, list(summary ORDER BY n, name) AS found FROM sheet s JOIN said d ON d.doc_id = s.doc_id AND len(list_filter(s.filePaths, lambda f: contains(f, d.name))) > 0 GROUP BY ALL
), merged AS (
  SELECT s.*, array_to_string(m.found, chr(10)) AS summary FROM sheet s LEFT JOIN met m ON m.doc_id = s.doc_id AND m.ord = s.ord AND m.kind = 'tables'
), filled AS (
  SELECT s.* EXCLUDE (summary), CASE
    WHEN s.summary IS NOT NULL AND s.summary <> 'Error generating summary.' OR m.found IS NULL THEN s.summary
    WHEN s.summary IS NULL AND m.found[1] <> 'Error generating summary.' THEN m.found[1]
    WHEN s.summary IS NULL THEN array_to_string(m.found[1:2], chr(10)) ELSE s.summary || chr(10) || m.found[1] END AS summary
  FROM merged s LEFT JOIN met m ON m.doc_id = s.doc_id AND m.ord = s.ord AND m.kind = 'figures'
)
"""
_SENTENCES = "list_filter(string_split(coalesce(answer, ''), '. '), lambda s: s <> '')"
ORACLE = {
    "latest_elements": "SELECT doc_id, pos, Path, Text, ObjectID FROM elements QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY arrived_at DESC) = 1",
    "section_assign": _ELEMENTS + "SELECT doc_id, pos, cls, page_no, title_id, section_id, text_id, table_id, figure_id FROM kept",
    "titles": _ELEMENTS + "SELECT doc_id, title_id, Text AS title_name, page_no AS page, ObjectID FROM kept WHERE is_title",
    "sections": _ELEMENTS + "SELECT doc_id, section_id, Text AS section_name, page_no AS page, ObjectID, cls = 'KEEP' AS is_exception FROM kept WHERE cls IN ('KEEP', 'HEADER')",
    "text_elements": _ELEMENTS
    + """SELECT doc_id, text_id, section_id, Path, page_no AS page, nullif(regexp_extract(Path, '//Document/Figure(\\[[0-9]+\\])?/'), '') AS add_element,
  nullif(regexp_extract(Path, '//Document/Table(\\[[0-9]+\\])?/'), '') AS add_element_table FROM kept WHERE cls = 'TEXT'""",
    "media_elements": _ELEMENTS + "SELECT doc_id, lower(cls) AS kind, CASE cls WHEN 'TABLE' THEN table_id ELSE figure_id END AS media_id, Path, array_to_string(filePaths, ', ') AS files FROM kept WHERE cls IN ('TABLE', 'FIGURE')",
    "section_chunks": _ELEMENTS + "SELECT doc_id, section_id, section_name, text_chunk, coalesce(array_to_string(ids, ','), '') AS text_id, coalesce(array_to_string(pages, ','), '') AS pages FROM whole",
    "exception_chunks": _ELEMENTS + "SELECT doc_id, section_id, section_name, array_to_string(t, '') AS text FROM whole WHERE cls = 'KEEP' AND t IS NOT NULL",
    "kept_sections": _HOUSE + "SELECT doc_id, section_id, Text AS section_name, page, ObjectID FROM kept WHERE cls = 'KEEP'",
    "kept_chunks": _HOUSE
    + """SELECT h.doc_id, h.section_id, h.Text AS section_name, string_agg(t.Text, '' ORDER BY t.pos) AS text
FROM kept h JOIN kept t ON t.doc_id = h.doc_id AND t.section_id = h.section_id AND t.cls = 'TEXT' WHERE h.cls = 'KEEP' GROUP BY ALL""",
    "final_checks": _ELEMENTS + "SELECT doc_id, section_id, length(text_chunk) > 3000 AS was_cut, CASE WHEN length(text_chunk) <= 3000 THEN text_chunk END AS text, true AS keeps_size, true AS lies_within FROM whole WHERE section_name IS NOT NULL",
    "split_checks": "SELECT DISTINCT doc_id, chunk_no, length(text_chunk) > 3000 AS was_cut, CASE WHEN length(text_chunk) <= 3000 THEN text_chunk END AS text, true AS keeps_size, true AS lies_within FROM chunks_data WHERE text_chunk IS NOT NULL",
    "qa_extract": f"""WITH said AS (
  SELECT qa_id, coalesce(question, '') AS q, chr(10) || '**Answer:** ' || coalesce(answer, '') AS a FROM qa_rows
), first AS (
  SELECT qa_id, q, regexp_replace(a, chr(10) || '[*]{{0,2}}Question(.|' || chr(10) || ')*$', '') AS a FROM said
)
SELECT qa_id, regexp_replace(replace(q, '*', ''), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS question,
  regexp_replace(replace(regexp_replace(a, '[*]{{0,2}}Answer[*]{{0,2}}:', '', 'g'), '*', ''), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS answer FROM first""",
    "section_sheet": _ELEMENTS
    + """, first AS (SELECT doc_id, arg_min(Text, pos) AS Title FROM kept WHERE is_title GROUP BY doc_id)
SELECT doc_id, section_id, section_name, text_chunk, Title FROM whole LEFT JOIN first USING (doc_id) WHERE section_name IS NOT NULL""",
    "signs_in_words": f"SELECT {_SIGNS('doc_id')} AS doc_id, pos, {_SIGNS('Path')} AS Path, {_SIGNS('Text')} AS Text, Page FROM elements",
    "media_inventory": _INVENTORY + "SELECT doc_id, files, object_id_file, general_path, array_to_string(p, '|') AS specific_paths, array_to_string(t, '|') AS texts, array_to_string(o, '|') AS object_ids_text, ord FROM sheet",
    "substring_merge": _INVENTORY + "SELECT doc_id, files, ord, summary FROM merged",
    "fallback_merge": _INVENTORY + "SELECT doc_id, files, ord, summary FROM filled",
    "conditional_update": _INVENTORY
    + """, taken AS (SELECT doc_id, object_id_file AS ObjectID, arg_max(struct_pack(s := summary), ord) AS new FROM filled GROUP BY ALL),
listed AS (SELECT DISTINCT doc_id, unnest(p) AS listed FROM filled),
emptied AS (SELECT DISTINCT e.doc_id, e.Path FROM latest e JOIN listed l ON l.doc_id = e.doc_id AND contains(l.listed, e.Path) WHERE e.filePaths IS NULL)
SELECT e.doc_id, e.pos, e.ObjectID, CASE WHEN e.filePaths IS NOT NULL AND t.new IS NOT NULL THEN t.new.s WHEN e.filePaths IS NULL AND x.Path IS NOT NULL THEN '' ELSE e.Text END AS Text
FROM latest e LEFT JOIN taken t ON t.doc_id = e.doc_id AND t.ObjectID = e.ObjectID LEFT JOIN emptied x ON x.doc_id = e.doc_id AND x.Path = e.Path""",
    "row_prose": """SELECT p_brand, string_agg('In row ' || n || ', The p_name is: ' || p_name || ' .  The p_type is: ' || p_type || ' .  The p_size is: ' || p_size || ' .', chr(10) ORDER BY p_partkey) AS summary
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) GROUP BY p_brand""",
    "word_validity": f"""WITH vocabulary AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(Title), '{_SPACE}+')) AS w FROM guidelines),
word AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: length(x) > 2)) AS w FROM documents),
sums AS (SELECT doc_id, count(*) AS n_words, count(v.w) AS n_valid FROM word LEFT JOIN vocabulary v ON v.w = lower(word.w) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_valid, 0) AS n_valid, coalesce(n_valid, 0) < coalesce(n_words, 0) * 0.9::DOUBLE AS is_gibberish FROM documents d LEFT JOIN sums USING (doc_id)""",
    "usable_chunks": """WITH written AS (
  SELECT doc_id, chunk_no, section_name, replace(replace(replace(replace(text_chunk, '≥', ' more than or equals to '), '≤', ' less than or equals to '), '>', ' more than '), '<', ' less than ') AS text_chunk FROM chunks_data
) SELECT * FROM written WHERE section_name IS NOT NULL AND length(text_chunk) > 100""",
    "chunk_slice": """WITH written AS (
  SELECT DISTINCT doc_id, chunk_no, section_name, replace(replace(replace(replace(text_chunk, '≥', ' more than or equals to '), '≤', ' less than or equals to '), '>', ' more than '), '<', ' less than ') AS text_chunk FROM chunks_data
) SELECT * FROM written WHERE section_name IS NOT NULL AND length(text_chunk) > 100 ORDER BY doc_id, chunk_no LIMIT 2 OFFSET 8""",
    "citations": """SELECT qa_id, CASE WHEN regexp_matches(lower(question), 'the source|this information|these guidelines|this source') THEN 1 ELSE 0 END AS flag_source,
  'For more information, refer to clinical protocol ' || Title || ', Section ' || section || ', Pages [' || array_to_string(pages, ', ') || ']' AS reference_text FROM qa_rows""",
    "faithfulness_score": f"""SELECT qa_id, CASE WHEN Flag_Source = 1 THEN NULL WHEN answer = '' THEN 0.0 WHEN contexts IS NULL OR len({_SENTENCES}) = 0 THEN NULL
  ELSE round(len(list_filter({_SENTENCES}, lambda s: contains(contexts, s)))::DOUBLE / len({_SENTENCES}), 6) END AS faithfulness FROM qa_rows""",
    "context_recall_score": f"""SELECT qa_id, CASE WHEN full_text IS NULL OR len({_SENTENCES}) = 0 THEN NULL
  ELSE round(len(list_filter({_SENTENCES}, lambda s: contains(full_text, s)))::DOUBLE / len({_SENTENCES}), 6) END AS context_recall FROM qa_rows""",
    "context_precision_score": f"""WITH each AS (
  SELECT qa_id, unnest(list_transform(string_split(contexts, chr(10) || chr(10)), lambda p: (len(list_filter({_SENTENCES}, lambda s: contains(p, s))) > 0)::INT)) AS v,
    generate_subscripts(string_split(contexts, chr(10) || chr(10)), 1) AS i FROM qa_rows WHERE contexts IS NOT NULL
), summed AS (SELECT *, sum(v) OVER (PARTITION BY qa_id ORDER BY i) AS k FROM each)
SELECT qa_id, round(sum(k::DOUBLE / i * v) / (sum(v) + 1e-10::DOUBLE), 6) AS context_precision FROM summed GROUP BY qa_id""",
    "correctness_f1": """WITH sets AS (
  SELECT qa_id, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(answer, '')), '[^a-z0-9]+'), lambda w: w <> '')) AS a,
    list_distinct(list_filter(regexp_split_to_array(lower(coalesce(contexts, '')), '[^a-z0-9]+'), lambda w: w <> '')) AS r FROM qa_rows
), counted AS (SELECT qa_id, len(list_intersect(a, r))::DOUBLE AS tp, len(a) AS na, len(r) AS nr FROM sets),
f AS (SELECT qa_id, CASE WHEN tp > 0 THEN tp / (tp + 0.5::DOUBLE * (na - tp + nr - tp)) ELSE 0 END AS f1 FROM counted)
SELECT qa_id, round(f1, 6) AS statement_f1, round(0.75::DOUBLE * f1 + 0.25::DOUBLE * list_cosine_similarity([length(coalesce(contexts, ''))::DOUBLE, 100.0::DOUBLE], [length(coalesce(answer, ''))::DOUBLE, 100.0::DOUBLE]), 6) AS answer_correctness
FROM f JOIN qa_rows USING (qa_id)""",
    "answer_similarity": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "answer_relevancy": """SELECT a.vec_id, round(CASE WHEN a.label = 0 THEN 0::DOUBLE
  ELSE (list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) + list_cosine_similarity(a.embedding::DOUBLE[], c.embedding::DOUBLE[])) / 2 END, 6) AS answer_relevancy
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 JOIN embeddings c ON c.vec_id = a.vec_id + 2""",
    "repaired_replies": """SELECT qa_id, 's ' || regexp_replace(coalesce(question, ''), '[^A-Za-z0-9 .]', ' ', 'g') AS statement, 'r1' AS reason, '1' AS verdict FROM qa_rows
UNION ALL SELECT qa_id, 's ' || regexp_replace(coalesce(section, ''), '[^A-Za-z0-9 .]', ' ', 'g'), 'r2', '0' FROM qa_rows""",
    "unprocessed_documents": "SELECT doc_id, Title FROM guidelines g WHERE NOT EXISTS (SELECT 1 FROM structured_data s WHERE s.doc_id = g.doc_id)",
}
