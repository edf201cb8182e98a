"""Queries of the text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from florilege.functions.citation import OCCASION_PHRASES, OCCASION_WORDS
from florilege.llm.canon import map_values
from florilege.llm.names import linked_names
from florilege.llm.neardup import similar_classes, similar_pairs
from florilege.llm.packing import pack_items
from florilege.llm.spans import repeated_units, shared_spans, without_repeats
from florilege.llm.sql import SQL as SQL
from florilege.llm.tokens import decode, encode, vocabulary
from florilege.session import table, written


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what the citation reader takes for an occasion are other wordings of the list's; plurals follow from rules
    aliases = {"occasion": [(wording, text) for wording, text in OCCASION_PHRASES + OCCASION_WORDS if not wording.startswith(text)]}
    return map_values(table(spark, sf_dir, "sources"), "source_id", ["work_title", "publisher", "occasion"], table(spark, sf_dir, "canon_items"), aliases)


def p4_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all that p4_found gives, the values that are an entry but for letter case and spaces, which SQL can tell."""
    plain = lambda c: F.when(c.rlike("^[A-Za-z0-9 ]*[A-Za-z0-9][A-Za-z0-9 ]*$"), F.lower(F.trim(F.regexp_replace(c, " +", " "))))
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in ("work_title", "publisher", "occasion")]))
    typed = table(spark, sf_dir, "sources").select("source_id", fields.alias("x")).select("source_id", "x.field", plain(F.col("x.v")).alias("k"))
    listed = table(spark, sf_dir, "canon_items").select("field", plain(F.col("canonical")).alias("k")).distinct()
    return p4_found(spark, sf_dir).join(typed.join(listed, ["field", "k"], "left_semi").select("source_id", "field"), ["source_id", "field"], "left_semi")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(table(spark, sf_dir, "quotes"), "quote_no", "text")


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "quotes"), "quote_no", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_names(table(spark, sf_dir, "agents"), "agent_id", {"name": "kind in ('person', 'unknown')", "played_by": None})


def p7_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all that p7_found links, the pairs of which one is the other with the family name first, which SQL can tell."""
    agents = table(spark, sf_dir, "agents").select("agent_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in ("name", "played_by")])).alias("x")).select("agent_id", "x.*")
    turned = F.lower(F.regexp_replace("v", "^([^,]+), ([^,]+)$", "$2 $1"))
    keyed = agents.where(F.col("v").rlike("^[A-Za-z]{3,} [A-Za-z]{3,}$|^[A-Za-z]{3,}, [A-Za-z]{3,}$")).select("agent_id", "field", turned.alias("k"), F.col("v").contains(",").alias("c"))
    a = keyed.select("field", F.col("agent_id").alias("agent_id_1"), F.col("k").alias("k1"), F.col("c").alias("c1"))
    b = keyed.select("field", F.col("agent_id").alias("agent_id_2"), F.col("k").alias("k2"), F.col("c").alias("c2"))
    both = p7_found(spark, sf_dir).join(a, ["field", "agent_id_1"]).join(b, ["field", "agent_id_2"])
    return both.where("k1 = k2 and c1 <> c2").select("field", "agent_id_1", "agent_id_2")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary())


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents turned back into their texts."""
    return decode(p8_ids(spark, sf_dir), "doc_id", "ids", vocabulary()).select("doc_id", F.md5("text").alias("text_md5"))


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = written(encode(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary(), only_count=True), "sizes")
    caps = table(spark, sf_dir, "pack_capacity").groupBy("capacity_id").agg(F.max("capacity_tokens").alias("c"))
    return sizes, pack_items(sizes, "doc_id", "n_tokens", [(r[0], r[1]) for r in caps.collect()])


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)[1]


def p9_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any packing: documents, and how many containers are overfull or hold parts that overlap, and how many
    documents are cut though they fit or don't have all their tokens."""
    sizes, packed = _packed(spark, sf_dir)
    packed = written(packed, "packed")
    caps = table(spark, sf_dir, "pack_capacity").groupBy("capacity_id").agg(F.max("capacity_tokens").alias("c"))
    room = packed.where("n_tokens > 0").withColumn("before", F.max(F.col("start") + F.col("n_tokens")).over(Window.partitionBy("capacity_id", "container_id").orderBy("start", "doc_id", "part").rowsBetween(Window.unboundedPreceding, -1)))
    full = room.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("start") + F.col("n_tokens")).alias("top"), F.max(F.col("start") < F.col("before")).alias("over"))
    full = full.join(caps, "capacity_id").groupBy("capacity_id").agg(F.count_if((F.col("n") > F.col("c")) | (F.col("top") > F.col("c"))).alias("n_overfull"), F.count_if("over").alias("n_overlapping"))
    docs = packed.groupBy("capacity_id", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts")).join(sizes, "doc_id").join(caps, "capacity_id")
    docs = docs.groupBy("capacity_id").agg(F.count("*").alias("n_documents"), F.count_if((F.col("parts") > 1) & (F.col("n_tokens") <= F.col("c"))).alias("n_cut"), F.count_if(F.col("n") != F.col("n_tokens")).alias("n_incomplete"))
    return docs.join(full, "capacity_id", "left")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stood in an earlier place."""
    kept = without_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return kept.select("doc_id", F.md5("text").alias("text_md5"), F.size("kept").alias("n_kept"))


QUERIES = {f.__name__: f for f in (p4_found, p4_folded, p6_found, p6_classes, p7_found, p7_reordered, p8_ids, p8_round_trip, p9_containers, p9_invariants, p10_found, p10_lines, p10_kept)}
