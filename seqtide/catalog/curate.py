"""Scans, sinks, filters, joins and counters on sequences, metadata and lineages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtide import sinks
from seqtide.catalog.registry import query
from seqtide.config import FULL, RANKS
from seqtide.functions import text as tx
from seqtide.operators import dedup, ledger, lineage
from seqtide.operators.skew import dense_index
from seqtide.plans import views
from seqtide.plans.views import duck, table
from seqtide.session import scratch_path
from seqtide.sources import fasta, lineages, manifest, metadata

RANK_LIST = ", ".join(f'"{r}"' for r in RANKS)
PART = "*.txt"  # Spark's own name for text part files


def written_fasta(spark: SparkSession, records: DataFrame) -> str:
    path = scratch_path(spark, "fasta")
    sinks.write_fasta(records, path)
    return path


@query("fasta_parse", duck("""
select accession, case when doc_id % 5 = 0 then null else taxid end as taxid,
       length(sequence) as bases, md5(sequence) as sequence_md5 from seqs""", "seqs"))
def fasta_parse(spark, sf):
    records = fasta.read_fasta(spark, written_fasta(spark, views.seqs(spark, sf)), PART)
    return records.select("accession", tx.taxid_of("header").alias("taxid"),
                          F.length("sequence").cast("long").alias("bases"),
                          F.md5("sequence").alias("sequence_md5"))


@query("fasta_roundtrip", duck("""
select header, sequence from seqs""", "seqs"))
def fasta_roundtrip(spark, sf):
    return fasta.read_fasta(spark, written_fasta(spark, views.seqs(spark, sf)), PART).select("header", "sequence")


@query("fasta_union", duck("""
select accession, lang, count(*) as copies from (
  select accession, string_split(header, ' ')[-1] as lang from seqs) s group by all""", "seqs"))
def fasta_union(spark, sf):
    """Many files in a tree of folders, one per language, read as one table."""
    root = scratch_path(spark, "tree")
    lang = F.element_at(F.split("header", " "), -1)
    records = views.seqs(spark, sf)
    (records.select(F.concat(F.lit(">"), "header", F.lit("\n"), "sequence").alias("value"), lang.alias("lang"))
     .write.partitionBy("lang").text(root))
    found = fasta.read_fasta(spark, root, PART)
    return found.groupBy("accession", F.element_at(F.split("header", " "), -1).alias("lang")).agg(
        F.count("*").alias("copies"))


@query("record_count", duck("select count(*) as records from seqs", "seqs"))
def record_count(spark, sf):
    return fasta.count_records(fasta.read_fasta(spark, written_fasta(spark, views.seqs(spark, sf)), PART))


@query("metadata_scan", duck("""
select accession, taxId as "taxId" from meta""", "meta"))
def metadata_scan(spark, sf):
    path = scratch_path(spark, "jsonl")
    views.meta(spark, sf).write.option("ignoreNullFields", "true").json(path)
    return metadata.read_metadata(spark, path).select("accession", "taxId")


@query("json_props", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
where json_valid(props)""")
def json_props(spark, sf):
    """Row-wise decoding of JSON text with undecodable lines skipped."""
    decoded = F.from_json("props", "k long, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return (table(spark, sf, "events").select("event_id", decoded.alias("j"))
            .where(F.col("j._bad").isNull()).select("event_id", "j.k"))


@query("metadata_last_wins", """
select user_id, event_type, value from (
  select *, row_number() over (partition by user_id order by event_id desc) as n from events) e
where n = 1""")
def metadata_last_wins(spark, sf):
    return metadata.last_wins(table(spark, sf, "events").select("user_id", "event_id", "event_type", "value"),
                              "user_id", "event_id").select("user_id", "event_type", "value")


@query("keep_list", duck("""
select distinct accession from meta where taxId is not null""", "meta"))
def keep_list(spark, sf):
    """Keep list written in taxid order, one key per line, and scanned again."""
    path = scratch_path(spark, "keep")
    keys = views.meta(spark, sf).where(F.col("taxId").isNotNull())
    sinks.write_keys(keys, path, order="taxId")
    return metadata.read_keys(spark, path).distinct()


@query("lineage_tsv_scan", duck(f"""
select accession, taxid, {RANK_LIST} from ranks""", "ranks"))
def lineage_tsv_scan(spark, sf):
    path = scratch_path(spark, "tsv")
    sinks.write_lineage_tsv(views.ranks(spark, sf), path)
    found = lineages.read_lineage_tsv(spark, path)
    return found.select("accession", "taxid", *[f"`{r}`" for r in RANKS])


LINES = """
select c_custkey, case when c_custkey % 13 = 0 then concat(c_custkey, chr(9), c_name)
  when c_custkey % 17 = 0 then concat('x', c_custkey, repeat(concat(chr(9), c_name), 7))
  else concat(c_custkey, chr(9), ' ', c_mktsegment, ' ', repeat(concat(chr(9), c_name), 6)) end as line
from {customer}"""


def lineage_lines(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LINES, customer=table(spark, sf, "customer"))


@query("parse_lineage_tsv", f"""
with lines as ({LINES.replace("{customer}", "customer")}),
f as (select string_split(line, chr(9)) as f from lines)
select f[1] as taxid, {", ".join(f'trim(f[{i + 2}]) as "{r}"' for i, r in enumerate(RANKS))}
from f where len(f) >= 8 and regexp_full_match(f[1], '[0-9]+')""")
def parse_lineage_tsv(spark, sf):
    return lineages.parse_lineage_lines(lineage_lines(spark, sf), "line")


@query("rejected_lineage_lines", f"""
with lines as ({LINES.replace("{customer}", "customer")}),
f as (select string_split(line, chr(9)) as f from lines)
select count(*) as lines, count_if(len(f) < 8)::bigint as short_lines,
       count_if(len(f) >= 8 and not regexp_full_match(f[1], '[0-9]+'))::bigint as bad_ids from f""")
def rejected_lineage_lines(spark, sf):
    size = F.size(F.split("line", "\t"))
    good = lineages.good_lineage_line("line")
    return lineage_lines(spark, sf).agg(F.count("*").alias("lines"), F.count_if(size < 8).alias("short_lines"),
                                        F.count_if((size >= 8) & ~good).alias("bad_ids"))


@query("tree_dump_scan", duck("""
select tax_id::bigint as tax_id, parent_id::bigint as parent_id, rank, name from tree""", "tree"))
def tree_dump_scan(spark, sf):
    """The tree written in the public dump format, with synonyms, and scanned."""
    nodes, names = scratch_path(spark, "nodes"), scratch_path(spark, "names")
    tree = views.tree(spark, sf)
    end = F.lit("\t|")

    def line(*cells):
        return F.concat(F.concat_ws("\t|\t", *[F.col(c).cast("string") if isinstance(c, str) else c
                                               for c in cells]), end).alias("value")
    tree.select(line("tax_id", "parent_id", "rank", F.lit("XX"))).write.text(nodes)
    (tree.select(line("tax_id", "name", F.lit(""), F.lit("scientific name")))
     .union(tree.select(line("tax_id", F.lower("name"), F.lit(""), F.lit("synonym")))).write.text(names))
    return lineages.read_tree_dump(spark, nodes, names).select("tax_id", "parent_id", "rank", "name")


@query("manifest_audit", """
select cast(s_suppkey as varchar) as path, case when s_suppkey % 7 = 3 then 'missing' when s_suppkey % 3 = 0 then 'corrupt'
       else 'ok' end as status from supplier""")
def manifest_audit(spark, sf):
    """A file per supplier, some never written, against a manifest with some wrong checksums."""
    root, suppliers = scratch_path(spark, "files"), table(spark, sf, "supplier").select("s_suppkey", "s_name")
    sinks.write_file_per_key(suppliers.where("s_suppkey % 7 <> 3").withColumnRenamed("s_name", "value"), "s_suppkey", root)
    found = manifest.file_checksums(spark, root, PART).withColumn("path", F.regexp_extract("path", r"s_suppkey=(\d+)/", 1))
    text = F.concat("s_name", F.when(F.col("s_suppkey") % 3 == 0, "?").otherwise(""), F.lit("\n"))
    listed = suppliers.select(F.col("s_suppkey").cast("string").alias("path"), F.md5(text).alias("md5"))
    return manifest.audit(listed, found)


@query("header_fields", duck("""
select doc_id, regexp_extract(header, '^(\\S+)', 1) as accession,
       nullif(regexp_extract(header, '\\|taxid\\|(\\d+)\\|', 1), '') as taxid from seqs""", "seqs"))
def header_fields(spark, sf):
    return views.seqs(spark, sf).select("doc_id", tx.accession_of("header").alias("accession"),
                                        tx.taxid_of("header").alias("taxid"))


@query("valid_keys", duck("""
select accession, taxId as "taxId" from meta where taxId is not null and accession <> ''""", "meta"))
def valid_keys(spark, sf):
    return views.meta(spark, sf).where(tx.valid_key("accession", "taxId"))


@query("restricted_map", duck("""
select m.accession, cast(m.taxId as varchar) as taxid from meta m
where m.taxId is not null and m.accession in (
  select s.accession from seqs s join labels l using (doc_id))""", "meta"))
def restricted_map(spark, sf):
    """Metadata map limited to the accessions that have a label."""
    wanted = views.seqs(spark, sf).join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    rows = views.meta(spark, sf).withColumn("position", F.lit(0))
    return metadata.taxid_map(rows, restrict_to=wanted)


@query("term_filter", """
select doc_id, source from documents
where contains(lower(text), 'marine') or contains(lower(text), 'the') or contains(lower(text), 'eau')""")
def term_filter(spark, sf):
    return table(spark, sf, "documents").where(tx.any_term("text", ["Marine", "the", "eau"])).select("doc_id", "source")


@query("habitat_terms", """
select p_partkey, p_name from part where """ + " or ".join(
    f"contains(lower(p_name), '{t.lower()}')" for t in (*FULL.habitat_terms, "a")))
def habitat_terms(spark, sf):
    return table(spark, sf, "part").where(tx.any_term("p_name", (*FULL.habitat_terms, "a"))).select("p_partkey", "p_name")


@query("resume_antijoin", """
select doc_id, n_chars from documents where doc_id not in (select doc_id from labels)""")
def resume_antijoin(spark, sf):
    return dedup.pending(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "n_chars")


@query("default_fill", duck("""
select s.accession, coalesce(cast(m.taxId as varchar), '') as taxid
from seqs s left join meta m using (accession)""", "meta"))
def default_fill(spark, sf):
    joined = views.seqs(spark, sf).select("accession").join(views.meta(spark, sf), "accession", "left")
    return joined.select("accession", tx.blank(F.col("taxId").cast("string")).alias("taxid"))


@query("representative_per_group", duck("""
select taxId as "taxId", first(accession order by accession) as representative from meta group by taxId""", "meta"))
def representative_per_group(spark, sf):
    return dedup.representatives(views.meta(spark, sf)).orderBy(F.col("taxId").asc_nulls_last())


@query("distinct_taxa", duck("""
select count(distinct taxId) as distinct_groups from meta""", "meta"))
def distinct_taxa(spark, sf):
    return dedup.distinct_groups(views.meta(spark, sf)).select("distinct_groups")


@query("ordered_head", """select l_orderkey, l_linenumber, l_extendedprice from lineitem
order by l_extendedprice desc, l_orderkey, l_linenumber limit 1000""")
def ordered_head(spark, sf):
    """A global top-n: the limit is the feature."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dedup.head(rows, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 1000)


@query("keep_list_order", duck("""
select row_number() over (order by taxId nulls last, accession) as line, accession from (
  select taxId, min(accession) as accession from meta group by taxId)""", "meta"))
def keep_list_order(spark, sf):
    """A keep list written in taxid order and read again with its line numbers."""
    path = scratch_path(spark, "keep")
    keys = dedup.representatives(views.meta(spark, sf)).select(F.col("representative").alias("accession"), "taxId")
    sinks.write_keys(keys, path, order="taxId")
    lines = dense_index(metadata.read_keys(spark, path, position=True), ["position"], "line")
    return lines.select((F.col("line") + 1).alias("line"), "accession")


@query("distinct_keys", """select distinct l_suppkey, l_returnflag from lineitem""")
def distinct_keys(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("keep_filter", duck("""
select accession, md5(sequence) as sequence_md5 from seqs where accession in (
  select min(accession) from meta group by taxId)""", "meta"))
def keep_filter(spark, sf):
    """One representative per taxon, then only their sequences."""
    keys = dedup.representatives(views.meta(spark, sf)).select(F.col("representative").alias("accession"))
    return dedup.keep(views.seqs(spark, sf), keys).select("accession", F.md5("sequence").alias("sequence_md5"))


MAP = """
hdr as (select accession, case when doc_id % 3 = 0 then cast(doc_id % 89 + 9 as varchar) else taxid end as taxid
        from seqs where doc_id % 5 <> 0),
js as (select accession, cast(taxId as varchar) as taxid from meta where taxId is not null),
map as (select accession, coalesce(js.taxid, hdr.taxid) as taxid from hdr full join js using (accession))"""


def merged_map(spark: SparkSession, sf: str) -> DataFrame:
    """Every third header comes a second time with another taxid; the later one holds."""
    rows = views.meta(spark, sf).withColumn("position", F.lit(0))
    seqs = views.seqs(spark, sf).select("doc_id", "accession", "header")
    later = seqs.where("doc_id % 3 = 0 and doc_id % 5 <> 0").withColumn(
        "header", F.concat("accession", F.lit(" |taxid|"), F.col("doc_id") % 89 + 9, F.lit("|")))
    headers = seqs.withColumn("position", F.lit(1)).unionByName(later.withColumn("position", F.lit(2)))
    return lineage.merge_maps(lineage.header_map(headers), metadata.taxid_map(rows))


@query("map_merge", duck("with " + MAP + " select accession, taxid from map", "meta"))
def map_merge(spark, sf):
    return merged_map(spark, sf)


UP = """
up as (select tax_id, tax_id as at, parent_id, rank, name from tree
       union all select u.tax_id, t.tax_id, t.parent_id, t.rank, t.name
       from up u join tree t on t.tax_id = u.parent_id where u.at <> u.parent_id),
named as (select tax_id, """ + ", ".join(
    f"max(case when rank = '{r}' then name end) as r{i}" for i, r in enumerate(RANKS)) + """
       from up group by tax_id),
lin as (select tax_id, """ + ", ".join(
    "coalesce(r{i}, {gap}'') as \"{r}\"".format(
        i=i, r=r, gap="".join(f"'unclassified ' || r{j} || ' {r}', " for j in range(i - 1, -1, -1)))
    for i, r in enumerate(RANKS)) + " from named)"


@query("lineage_ranks", duck(f"with recursive {UP} select tax_id, {RANK_LIST} from lin", "tree"))
def lineage_ranks(spark, sf):
    return lineage.tree_lineages(views.tree(spark, sf))


@query("lineage_merged", duck(f"""with recursive {UP} select tax_id, {RANK_LIST} from lin
union all select tax_id + 900000, {RANK_LIST} from lin where tax_id > 100000 and tax_id % 7 = 0""", "tree"))
def lineage_merged(spark, sf):
    """Old taxids that were merged into others have the lineage of these."""
    tree = views.tree(spark, sf)
    merged = tree.where("tax_id > 100000 and tax_id % 7 = 0").select(
        (F.col("tax_id") + 900000).alias("old_id"), F.col("tax_id").alias("new_id"))
    return lineage.tree_lineages(tree, merged=merged)


def taxon_lineages(spark: SparkSession, sf: str, whole: bool = True) -> DataFrame:
    """Lineages under the small taxids of the sequences: taxid t stands for customer t.
    Unless ``whole``, one class counts as missing from the tree, so some taxids are unknown."""
    found = lineage.tree_lineages(views.tree(spark, sf)).where(F.col("tax_id") > 100000)
    known = found if whole else found.where(~F.col("class").like("%BUILDING"))
    return known.select((F.col("tax_id") - 100000).cast("string").alias("taxid"), *[f"`{r}`" for r in RANKS])


TAXA = MAP + "," + UP + f""",
tl as (select cast(tax_id - 100000 as varchar) as taxid, {RANK_LIST} from lin where tax_id > 100000)"""
SOME_TAXA = TAXA[:-1] + """ and "class" not like '%BUILDING')"""


@query("annotate", duck(f"with recursive {TAXA} select accession, taxid, {RANK_LIST} from map join tl using (taxid)",
                        "meta", "tree"))
def annotate(spark, sf):
    return lineage.annotate(merged_map(spark, sf), taxon_lineages(spark, sf))


@query("unmatched", duck(f"""with recursive {SOME_TAXA} select accession, taxid from map
where taxid not in (select taxid from tl)""", "meta", "tree"))
def unmatched(spark, sf):
    return lineage.unmatched(merged_map(spark, sf), taxon_lineages(spark, sf, whole=False))


@query("coverage", duck(f"""with recursive {SOME_TAXA}
select count_if(tl.taxid is not null)::bigint as annotated, count_if(tl.taxid is null)::bigint as without_lineage,
       count(distinct map.taxid) as distinct_taxids from map left join tl using (taxid)""", "meta", "tree"))
def coverage(spark, sf):
    return lineage.coverage(merged_map(spark, sf), taxon_lineages(spark, sf, whole=False))


@query("id_format", """
select o_orderkey, 'ACC_' || lpad(cast(o_orderkey as varchar), cast(greatest(6, length(cast(o_orderkey as varchar))) as int), '0') as accession
from orders""")
def id_format(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", tx.sequence_id("o_orderkey").alias("accession"))


STAGES = ["view", "click", "signup", "purchase", "error", "dispatch"]


def event_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as ledger rows: a user is a run, an event type a stage, a value seconds."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run"), F.col("event_type").alias("stage"),
        F.lit("elapsed_s").alias("metric"), "value")


@query("run_summary", """
select cast(user_id as varchar) as run, """ + ", ".join(
    f"round(sum(case when event_type = '{s}' then value end) / 60, 4) as \"{s}\"" for s in STAGES)
    + " from events group by 1")
def run_summary(spark, sf):
    return ledger.run_summary(event_ledger(spark, sf), STAGES)


@query("stage_status", f"""
with stages as (select unnest({STAGES}) as stage),
spent as (select cast(user_id as varchar) as run, event_type as stage, sum(value) as s from events group by 1, 2)
select run, stage, s is not null as done, round(coalesce(s, 0) / 60, 4) as minutes
from (select distinct run from spent) r cross join stages left join spent using (run, stage)""")
def stage_status(spark, sf):
    return ledger.stage_status(event_ledger(spark, sf), STAGES)


@query("run_ledger", duck(f"""with recursive {TAXA}
select 'representatives' as stage, 'distinct_taxa' as metric, cast(count(distinct coalesce(taxId, -1)) as double) as value from meta
union all select 'lineage', 'n_annotated', cast(count(*) as double) from map join tl using (taxid)
union all select 'lineage', 'n_taxids', cast(count(distinct taxid) as double) from map""", "meta", "tree"))
def run_ledger(spark, sf):
    """Two stages run through the ledger; the elapsed times are left out of the result."""
    path = scratch_path(spark, "ledger")
    book = ledger.Ledger(spark, f"{path}/rows")
    book.stage("representatives", f"{path}/reps", lambda: dedup.representatives(views.meta(spark, sf)),
               metric="distinct_taxa")
    mapped = merged_map(spark, sf)
    book.stage("lineage", f"{path}/annotated",
               lambda: lineage.annotate(mapped, taxon_lineages(spark, sf)), metric="n_annotated")
    n = mapped.agg(F.countDistinct("taxid")).first()[0]
    book.record("lineage", n_taxids=n)
    timed = (F.col("metric") == ledger.ELAPSED) | F.startswith("metric", F.lit(ledger.BUILT))
    return book.rows().where(~timed).select("stage", "metric", "value")
