"""Queries of the operators for training data, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docprep.llm import language, lookalike, mixing, neardup, packing, pairs, pieces, reading
from docprep.llm.oracle import ORACLE  # noqa: F401
from docprep.llm.tokens import with_token_counts
from docprep.session import shared_path, table, tune
from docprep.sources.files import list_files

#: Sequence length, similarity and least number of sequences of the rewritten QA rows.
QA_WORDS, QA_SIMILARITY, QA_LEAST = 3, 0.6, 40


def _qa_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    qa = table(tune(spark), sf_dir, "qa_rows")
    text = F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("answer", F.lit("")))
    return neardup.near_duplicates(qa, "qa_id", text, QA_WORDS, QA_SIMILARITY, QA_LEAST)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neardup.member_pairs(*_qa_links(spark, sf_dir))
    return pairs.select(F.col("a").alias("qa_id_a"), F.col("b").alias("qa_id_b"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicate_groups(*_qa_links(spark, sf_dir))
    return groups.withColumnRenamed("id", "qa_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(tune(spark), sf_dir, "documents")
    models = language.fit(*language.labelled_texts(documents, "doc_id", "text", "lang"))
    return pairs.broken_pairs(table(spark, sf_dir, "qa_rows"), languages=models)


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of elements and chunks_data in its consistent form."""
    tune(spark)
    elements = table(spark, sf_dir, "elements").select(F.lit("elements").alias("tab"), "doc_id", "pos", F.col("Text").alias("text"))
    chunks = table(spark, sf_dir, "chunks_data").select(F.lit("chunks_data").alias("tab"), "doc_id", F.col("chunk_no").alias("pos"), F.col("text_chunk").alias("text"))
    return lookalike.consistent_form(elements.unionByName(chunks), "text", ["tab", "doc_id", "pos"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms(spark, sf_dir).where("is_case").select("tab", "doc_id", "pos").distinct()


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms(spark, sf_dir).select("tab", "doc_id", "pos", "form")


#: Limit and overlap of the pieces of chunks, in code points.
PIECE_LIMIT, PIECE_OVERLAP = 3000, 100


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    chunks = table(spark, sf_dir, "chunks_data").select(F.lit("chunks_data").alias("tab"), "doc_id", F.col("chunk_no").alias("pos"), "section_name", F.col("text_chunk").alias("text"))
    texts = table(spark, sf_dir, "text_chunks").select(F.lit("text_chunks").alias("tab"), "doc_id", F.col("text_id").alias("pos"), F.lit(None).cast("string").alias("section_name"), F.col("Text").alias("text"))
    return pieces.split_texts(chunks.unionByName(texts), "text", ["tab", "doc_id", "pos"], ("section_name",), PIECE_LIMIT, PIECE_OVERLAP)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that come out in more than one piece."""
    return p5_pieces(spark, sf_dir).where("piece_no = 1").select("tab", "doc_id", "pos").distinct()


def p5_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each text that its pieces cover it, keep within the limit and overlap by no more than asked."""
    cut_up = p5_pieces(spark, sf_dir)
    item = ["tab", "doc_id", "pos", "section_name"]
    # texts that share a key are told apart by what they are cut into
    shape = cut_up.select(*item, "piece_no", "start", "end", F.length("piece").alias("n"), F.xxhash64("piece").alias("h"))
    equal = shape.groupBy(*shape.columns).agg(F.count("*").alias("copies"))
    ordered = equal.groupBy(*item).agg(F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "n", "copies"))).alias("p"))
    steps = F.zip_with(F.slice("p", 2, F.size("p")), F.col("p"), lambda after, before: before["end"] - after["start"])
    steps = F.filter(steps, lambda x: x.isNotNull())
    return ordered.select(
        *item,
        F.col("p")[F.size("p") - 1]["end"].alias("n_chars"),
        F.col("p")[0]["copies"].alias("copies"),
        (F.size("p") > 1).alias("was_cut"),
        ((F.col("p")[0]["start"] == 0) & F.forall(steps, lambda x: x >= 0)).alias("is_covered"),
        F.forall("p", lambda x: (x["n"] <= PIECE_LIMIT) & (x["n"] == x["end"] - x["start"])).alias("is_within"),
        F.forall(steps, lambda x: x <= PIECE_OVERLAP).alias("overlaps_within"),
    )


def p5_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks written as text files and cut by byte ranges: the bytes covered, and whether all pieces keep the limits."""
    chunks = table(tune(spark), sf_dir, "chunks_data").where("text_chunk IS NOT NULL").select("text_chunk")
    folder = shared_path(spark, "texts")
    chunks.write.option("lineSep", "\n\n").text(folder)
    found = pieces.split_files(list_files(spark, folder, "*.txt"), PIECE_LIMIT, PIECE_OVERLAP)
    after = Window.partitionBy("path").orderBy("piece_no")
    overlap = F.coalesce(F.lag("end_byte").over(after) - F.col("start_byte"), F.lit(0))
    steps = found.select(F.length("piece").alias("n"), "start_byte", "end_byte", overlap.alias("overlap"))
    return steps.agg(
        F.coalesce(F.sum(F.col("end_byte") - F.col("start_byte") - F.col("overlap")), F.lit(0)).alias("n_bytes"),
        F.coalesce(F.max("n") <= PIECE_LIMIT, F.lit(True)).alias("is_within"),
        F.coalesce(F.bool_and((F.col("overlap") >= 0) & (F.col("overlap") <= 4 * PIECE_OVERLAP)), F.lit(True)).alias("overlaps_within"),
    )


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = with_token_counts(table(tune(spark), sf_dir, "documents"), "text", ["doc_id"])
    return packing.pack(sizes, "doc_id", "n_tokens", table(spark, sf_dir, "container_specs"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_rates(p6_containers(spark, sf_dir), table(spark, sf_dir, "container_specs"))


def p6_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What containers hold when texts are measured in characters: all items, whole unless above the capacity, none overfull."""
    specs = table(tune(spark), sf_dir, "container_specs")
    packed = packing.pack(table(spark, sf_dir, "documents"), "doc_id", "n_chars", specs)
    sized = packed.join(F.broadcast(specs), "spec_id")  # pack() has checked that specifications are few
    loads = sized.groupBy("spec_id", "container_id", "capacity_tokens", "gap_tokens").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"), F.count_if(F.col("piece_no") == 0).alias("items"))
    room = F.col("n") + (F.col("k") - 1) * F.col("gap_tokens") > F.col("capacity_tokens")
    totals = loads.groupBy("spec_id").agg(F.sum("items").alias("items"), F.sum("k").alias("pieces"), F.sum("n").alias("n_chars"), F.count_if(room).alias("overfull"))
    pieces_of = sized.groupBy("spec_id", "doc_id", "capacity_tokens").agg(F.sum("n_tokens").alias("n"), F.max("piece_no").alias("last"))
    cut_up = pieces_of.groupBy("spec_id").agg(F.count_if((F.col("last") > 0) & (F.col("n") <= F.col("capacity_tokens"))).alias("cut_below_capacity"))
    return totals.join(cut_up, "spec_id")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = with_token_counts(table(tune(spark), sf_dir, "documents"), "text", ["doc_id", "source"])
    return mixing.mix(sizes, "doc_id", "source", "n_tokens", table(spark, sf_dir, "mix_targets"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p7_planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What water-filling gives each source when texts are measured in characters."""
    documents = table(tune(spark), sf_dir, "documents")
    shares = mixing.mix(documents, "doc_id", "source", "n_chars", table(spark, sf_dir, "mix_targets"))[1]
    return shares.select("source", "target_share", "max_repeats", "available", F.col("planned_tokens").alias("planned"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(tune(spark), sf_dir, "documents")
    model = reading.fit(*reading.labelled_sample(documents, table(spark, sf_dir, "reading_labels"), "doc_id", "text", "level"))
    found = reading.reading_levels(documents, model, keep=("lang",))
    return found.withColumn("band", F.when(F.col("n_words") > 0, reading.band(reading.grade(F.col("n_letters"), F.col("n_words"), F.col("n_ends")))))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The band of each English document, from the counts of its classified sentences."""
    return _levels(spark, sf_dir).where("lower(lang) LIKE 'en%' AND n_words > 0").select("doc_id", "band")


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).select("doc_id", "n_sentences", "n_words", "distribution", "difficulty", "band")


def p8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that bands come from, of every document."""
    return _levels(spark, sf_dir).select("doc_id", "n_words", "n_letters", "n_ends", "band")


QUERIES = {
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_forms": p4_forms,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p5_cover": p5_cover,
    "p5_files": p5_files,
    "p6_containers": p6_containers,
    "p6_fill": p6_fill,
    "p6_contents": p6_contents,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_planned": p7_planned,
    "p8_found": p8_found,
    "p8_levels": p8_levels,
    "p8_counts": p8_counts,
}
