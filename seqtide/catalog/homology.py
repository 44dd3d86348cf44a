"""Near-identical sequences, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqtide.catalog.encode import kmers_sql
from seqtide.catalog.registry import query
from seqtide.config import FULL
from seqtide.functions.kmers import PRIME
from seqtide.operators import containment, homology
from seqtide.operators.dedup import copy_groups
from seqtide.plans import views
from seqtide.plans.views import duck
from seqtide.session import materialise

K, M = FULL.kmer, FULL.kmers_per_sequence
ID, COV = FULL.min_identity, FULL.min_coverage

SKETCH = f"""{kmers_sql(K)},
fp as (select accession, h as kmer, min(pos) as position from km group by all),
sk as (select * from fp qualify row_number() over (partition by accession order by kmer) <= {M})"""
# all later steps work on one sequence per group of identical ones
UNIQUE = f"""
cg as (select sequence, min(accession) as representative, count(*) as n from strains group by sequence),
uniq as (select representative as accession, sequence, length(sequence) as len from cg),
{SKETCH.replace("from seqs where", "from uniq where")},
su as (select * from sk join uniq using (accession)),
ct as (select kmer, first(struct_pack(acc := accession, len := len, pos := position) order by len desc, accession) as c,
              count(*) as n from su group by kmer having count(*) > 1)"""
CAND = UNIQUE + """,
hold as (select su.*, c, n from su join ct using (kmer)),
-- holders by length: each meets the longest and the next two
pairs_of as (select c.acc as centre, accession as member, c.pos - position as diagonal, c.len as centre_length, len as member_length
             from hold where accession <> c.acc
             union all
             select one.accession, other.accession, one.position - other.position, one.len, other.len
             from (select *, row_number() over (partition by kmer order by len desc, accession) as i from hold) one
             join (select *, row_number() over (partition by kmer order by len desc, accession) as i from hold) other
             on one.kmer = other.kmer and other.i - one.i between 1 and 2),
cand as (select distinct * from pairs_of)"""
PAIRS = CAND + f""",
ov as (select *, least(centre_length - greatest(diagonal, 0), member_length - greatest(-diagonal, 0)) as overlap from cand),
al as (select centre, member, centre_length, overlap / member_length as coverage,
              1 - hamming(substr(a.sequence, 1 + greatest(diagonal, 0), overlap),
                          substr(b.sequence, 1 + greatest(-diagonal, 0), overlap)) / overlap as identity
       from ov join uniq a on a.accession = centre join uniq b on b.accession = member
       where overlap / member_length >= {COV}),
pr as (select centre, member, centre_length, max(struct_pack(identity := identity, coverage := coverage)) as best
       from al where identity >= {ID} - 1e-12 group by all)"""
# members in order of length: one is covered when some centre of it is not covered itself
COVER = PAIRS + """,
ml as (select member, list(centre) as centres, row_number() over (order by any_value(len) desc, member) as i
       from pr join uniq on accession = member group by member),
rec as (select 0::bigint as i, []::varchar[] as covered
        union all
        select r.i + 1, case when len(list_filter(m.centres, lambda c: not list_contains(r.covered, c))) > 0
                             then list_append(r.covered, m.member) else r.covered end
        from rec r join ml m on m.i = r.i + 1),
cv as (select unnest(covered) as accession from rec where i = (select max(i) from rec)),
rp as (select member as accession, first(centre order by centre_length desc, centre) as representative
       from pr where member in (select accession from cv) and centre not in (select accession from cv) group by member),
reps as (select s.accession, coalesce(rp.representative, cg.representative) as representative
         from strains s join cg using (sequence) left join rp on rp.accession = cg.representative)"""


def _unique(spark, sf):
    seqs = materialise(views.strains(spark, sf), "records")
    groups = copy_groups(seqs).select(F.col("representative").alias("accession"))
    return materialise(seqs.join(groups, "accession", "left_semi"), "unique")


@query("kmer_sketches", duck(f"""with {SKETCH}
select accession, kmer, position from sk""", "seqs"))
def kmer_sketches(spark, sf):
    return homology.sketches(views.seqs(spark, sf), K, M).select("accession", "kmer", "position")


@query("kmer_centres", duck(f"""with {UNIQUE}
select kmer, c.acc as centre, c.len as centre_length, c.pos as centre_position, n from ct""", "strains"))
def kmer_centres(spark, sf):
    return homology.kmer_centres(homology.sketches(_unique(spark, sf), K, M))


@query("kmer_candidates", duck(f"with {CAND} select * from cand", "strains"))
def kmer_candidates(spark, sf):
    sketch = materialise(homology.sketches(_unique(spark, sf), K, M), "sketch")
    return homology.candidates(sketch, homology.kmer_centres(sketch))


@query("homology_pairs", duck(f"""with {PAIRS}
select centre, member, round(best.identity, 6) as identity, round(best.coverage, 6) as coverage from pr""", "strains"))
def homology_pairs(spark, sf):
    unique = _unique(spark, sf)
    sketch = materialise(homology.sketches(unique, K, M), "sketch")
    found = homology.aligned_pairs(homology.candidates(sketch, homology.kmer_centres(sketch)), unique, ID, COV)
    return found.select("centre", "member", F.round("identity", 6).alias("identity"), F.round("coverage", 6).alias("coverage"))


def _clusters(spark, sf):
    return homology.homology_clusters(materialise(views.strains(spark, sf), "records"), K, M, ID, COV)


@query("homology_reps", duck(f"with recursive {COVER} select accession, representative from reps", "strains"))
def homology_reps(spark, sf):
    return _clusters(spark, sf)


@query("homology_sizes", duck(f"""with recursive {COVER}
select representative, count(*) as members from reps group by 1""", "strains"))
def homology_sizes(spark, sf):
    return homology.cluster_sizes(_clusters(spark, sf))


CK, CUT = containment.K, PRIME // containment.SCALE
NEAR = f" and (a.i = 1 or b.i - a.i <= {homology.NEXT_HOLDERS})"
SIMILAR = f"""
gu as (select min(accession) as accession, sequence, length(sequence) as len from fragments group by sequence),
{kmers_sql(CK).replace("from seqs where", "from gu where")},
kept as (select distinct accession, len, h from km join gu using (accession) where h < {CUT}),
held as (select *, count(*) over (partition by h) as n, row_number() over (partition by h order by len desc, accession) as i from kept),
meet as (select distinct a.accession as longer, b.accession as shorter
         from held a join held b on a.h = b.h and a.i < b.i{NEAR}),
sizes as (select accession, count(*) as n from kept group by 1),
common as (select longer, shorter, count(*) as shared
           from meet join kept a on a.accession = longer join kept b on b.accession = shorter and b.h = a.h group by all),
alike as (select longer, shorter, shared, shared / (a.n + b.n - shared) as jaccard, shared / least(a.n, b.n) as containment
            from common join sizes a on a.accession = longer join sizes b on b.accession = shorter
            where shared / least(a.n, b.n) >= {containment.MIN_CONTAINMENT})"""


def _similar(spark, sf, near=None):
    records = materialise(views.fragments(spark, sf), "records", "zstd")
    groups = copy_groups(records).select(F.col("representative").alias("accession"))
    return containment.similar_pairs(records, near=near, among=groups)


# all that share a kept hash, however many hold it
@query("containment_candidates", duck(f"""with {SIMILAR.replace(NEAR, "")}
select longer, shorter, shared, round(jaccard, 6) as jaccard, round(containment, 6) as containment from alike""", "fragments"))
def containment_candidates(spark, sf):
    return _similar(spark, sf).select("longer", "shorter", "shared", F.round("jaccard", 6).alias("jaccard"),
                                      F.round("containment", 6).alias("containment"))


# what was planted: sequences of 1,000 letters at least, and the changed copy or part of each; copies of equal texts count once
PLANTED = """
select case when right(c.accession, 1) = 'F' then 'part' when s.doc_id % 5 = 0 then 'copy, 3 %' else 'copy, 8 %' end as kind,
       s.accession as a, c.accession as b
from {seqs} s join {fragments} c on c.accession in (concat(s.accession, 'F'), concat(s.accession, 'M'))
where length(s.sequence) >= 1000 and s.accession in (select accession from {unique}) and c.accession in (select accession from {unique})
"""


@query("containment_recall", duck(f"""with {SIMILAR},
planted_pairs as ({PLANTED.format(seqs="seqs", fragments="fragments", unique="gu")})
select kind, count(*) as planted, count(longer) as found
from planted_pairs left join alike on least(a, b) = least(longer, shorter) and greatest(a, b) = greatest(longer, shorter) group by 1""", "fragments"))
def containment_recall(spark, sf):
    """How many of the planted copies and parts are candidates with their original."""
    records = views.fragments(spark, sf)
    unique = materialise(copy_groups(records).select(F.col("representative").alias("accession")), "unique")
    planted = spark.sql(PLANTED.replace("c.accession in (concat(s.accession, 'F'), concat(s.accession, 'M'))",
                                        "s.accession = substr(c.accession, 1, length(c.accession) - 1)"),
                        seqs=views.seqs(spark, sf), fragments=records, unique=unique)
    planted = materialise(planted, "planted")  # before the blocks meet, whose tasks need the memory
    return containment.recall(planted, _similar(spark, sf, near=homology.NEXT_HOLDERS))
