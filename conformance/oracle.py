"""What each query must return, as SQL that states the definition.

Statistics are defined over the full site x sample grid with an interval
join, lookups and merges by plain joins: none of it shares its method with
the Spark side.
"""

from __future__ import annotations

from conformance.views import with_views

ID = "concat({0}contig, '-', cast({0}pos as string), '-', {0}ref, '-', {0}alt)"


def _id(alias: str = "s.") -> str:
    return ID.format(alias)


CELLS = """
cells as (
  select s.site_id, s.contig, s.pos, m.sample_id, g.site_id is not null as explicit,
    g.site_id is null and r.sample_id is not null as is_block,
    case when g.site_id is not null then g.a0 when r.sample_id is not null then 0 end as a0,
    case when g.site_id is not null then g.a1 when r.sample_id is not null then 0 end as a1,
    case when g.site_id is not null then g.gq else r.gq end as gq,
    case when g.site_id is not null then g.dp else r.dp end as dp
  from fx_sites s cross join fx_samples m
  left join fx_gt g on g.site_id = s.site_id and g.sample_id = m.sample_id
  left join fx_ref r on r.sample_id = m.sample_id and r.contig = s.contig and s.pos between r.pos and r.end_pos)"""

STATS = CELLS + """,
stats as (
  select site_id, count(a0) + count(a1) as an,
    count(case when a0 = 0 then 1 end) + count(case when a1 = 0 then 1 end) as ac0,
    count(case when a0 = 1 then 1 end) + count(case when a1 = 1 then 1 end) as ac1,
    count(case when a0 = 2 then 1 end) + count(case when a1 = 2 then 1 end) as ac2,
    count(case when a0 = 0 and a1 = 0 then 1 end) as hom0,
    count(case when a0 = 1 and a1 = 1 then 1 end) as hom1,
    count(case when a0 = 2 and a1 = 2 then 1 end) as hom2,
    count(a0) as n_called, count(case when a0 <> a1 then 1 end) as n_het,
    count(case when a0 > 0 or a1 > 0 then 1 end) as n_non_ref
  from cells group by site_id)"""

DOCS = STATS + f""",
docs as (
  select {_id()} as variant_id, s.contig as chrom, s.pos, s.ref, s.alt, s.alt2, coalesce(s.rsid, '') as rsids,
    '' as filters, t.ac1 as ac_total, t.an as an_total, t.ac1 / nullif(t.an, 0) as af_total, t.hom1 as hom_count,
    v.gene_symbol, v.consequence, v.impact, v.hgvsg as gdna, v.hgvsc as cdna, v.hgvsp as p_nomen,
    v.transcript_id as transcript, case when v.has_tc then c.cadd_phred end as cadd_score,
    case when v.has_tc then c.cadd_raw end as cadd_raw,
    k.clnsig as clinvar_sig, k.clnrevstat as clinvar_clnrevstat, f.af as gnomad_af, f.af_nfe as gnomad_nonfin,
    t.ac0, t.ac2
  from fx_sites s join stats t on t.site_id = s.site_id
  left join fx_vep v on v.site_id = s.site_id
  left join fx_cadd c on c.contig = s.contig and c.pos = s.pos and c.ref = s.ref and c.alt = s.alt
  left join fx_clinvar k on k.contig = s.contig and k.pos = s.pos and k.ref = s.ref and k.alt = s.alt
  left join fx_gnomad f on f.contig = s.contig and f.pos = s.pos and f.ref = s.ref and f.alt = s.alt
    and s.alt2 is null)"""

DOC_FIELDS = (
    "variant_id, chrom, pos, ref, alt, rsids, filters, ac_total, an_total, af_total, hom_count, gene_symbol, "
    "consequence, impact, gdna, cdna, p_nomen, transcript, cadd_score, clinvar_sig, clinvar_clnrevstat, "
    "gnomad_af, gnomad_nonfin"
)

SHAPE = (
    "variant_id, chrom, pos, ref, alt, rsids, ac_total as ac, an_total as an, af_total as af, "
    "hom_count as homozygote_count, filters, true as genome_empty"
)

KEYS = f"""keys as (select {_id()} as variant_id, s.contig as chrom, s.pos, s.ref, s.alt, s.rsid from fx_sites s)"""

IMPACTS = ", ".join(f"count(case when impact = '{i}' then 1 end) as n_{i.lower()}"
                    for i in ("HIGH", "MODERATE", "LOW", "MODIFIER"))

_FILL = {
    "consequence": "consequence", "symbol": "gene_symbol", "cadd": "cadd_score",
    "gnomad_af": "gnomad_af", "gnomad_nonfin": "gnomad_nonfin",
}
FILL = "count(*) as n_variants, " + ", ".join(
    f"count({c}) as has_{n}, round(100.0 * count({c}) / count(*), 6) as pct_{n}" for n, c in _FILL.items()
).replace("100.0", "1e2")
FREQ = "count(ac_total) as has_ac, round(avg(af_total), 6) as mean_af, cast(sum(hom_count) as bigint) as n_hom"
CLINICAL = """count(clinvar_sig) as has_clnsig,
  count(case when contains(lower(clinvar_sig), 'pathogenic') then 1 end) as has_pathogenic,
  count(case when contains(lower(clinvar_sig), 'pathogenic') and not contains(lower(clinvar_sig), 'conflicting')
        then 1 end) as has_pathogenic_strict"""

# Merge: alternates over the longest reference, sorted within the run that brought them.
MERGE = """
recs as (
  select sample_id, sidx, replace(replace(raw_contig, 'chrM', 'MT'), 'chr', '') as contig, pos, ref,
    replace(alts, ',<NON_REF>', '') as alt, gt, gq, dp
  from fx_gvcf where raw_contig <> 'chrM'),
longest as (select contig, pos, arg_max(ref, length(ref)) as long_ref from recs group by contig, pos),
padded as (
  select r.*, l.long_ref, concat(r.alt, substr(l.long_ref, length(r.ref) + 1)) as full_alt
  from recs r join longest l on l.contig = r.contig and l.pos = r.pos),
alts as (
  select contig, pos, any_value(long_ref) as long_ref, full_alt, {first_run} as first_run
  from padded group by contig, pos, full_alt),
lists as (
  select contig, pos, list(full_alt order by first_run, full_alt) as alt_list,
    concat(any_value(long_ref), ',', string_agg(full_alt, ',' order by first_run, full_alt)) as alleles
  from alts group by contig, pos)"""

CALLS = """
select p.contig, p.pos, p.sample_id, l.alleles, concat('0,', cast(list_position(l.alt_list, p.full_alt) as string)) as la,
  case when p.gt = './.' then null else p.gt end as lgt, p.gq, p.dp
from padded p join lists l on l.contig = p.contig and l.pos = p.pos"""

RUNS = "runs as (select distinct seq, run_id, status from fx_manifest)"

ORACLE = {
    "lgt_to_gt": """
select contig, pos, sample_id, concat_ws('/', cast(a0 as string), cast(a1 as string)) as gt from fx_gt
where a0 is not null union all select contig, pos, sample_id, null from fx_gt where a0 is null""",
    "variant_call_stats": f"""
with {STATS} select {_id()} as variant_id, t.ac1 as ac_total, t.an as an_total, t.ac1 / nullif(t.an, 0) as af_total,
  t.hom1 as hom_count
from fx_sites s join stats t on t.site_id = s.site_id""",
    "allele_call_stats": f"""
with {STATS}, a as (
  select site_id, contig, pos, 0 as allele_index, ref as allele from fx_sites
  union all select site_id, contig, pos, 1, alt from fx_sites
  union all select site_id, contig, pos, 2, alt2 from fx_sites where alt2 is not null)
select a.contig, a.pos, t.an, a.allele_index, a.allele,
  case a.allele_index when 0 then t.ac0 when 1 then t.ac1 else t.ac2 end as ac,
  case a.allele_index when 0 then t.ac0 when 1 then t.ac1 else t.ac2 end / nullif(t.an, 0) as af,
  case a.allele_index when 0 then t.hom0 when 1 then t.hom1 else t.hom2 end as hom
from a join stats t on t.site_id = a.site_id""",
    "dimensions": "select (select count(*) from fx_sites) as n_variants, (select count(*) from fx_samples) as n_samples",
    "sample_count": "select count(*) as n_samples from fx_samples",
    "densify": f"""
with {CELLS} select contig, pos, sample_id,
  case when a0 is not null then concat(cast(a0 as string), '/', cast(a1 as string)) end as gt, gq, dp, is_block
from cells where explicit or is_block""",
    "block_coverage": """
select s.contig, s.pos, count(r.sample_id) as n_ref from fx_sites s
left join fx_ref r on r.contig = s.contig and s.pos between r.pos and r.end_pos group by s.contig, s.pos""",
    "carved_reference_bases": """
with hidden as (
  select b.sample_id, b.contig, count(*) as n from fx_ref b
  join fx_lgt c on c.sample_id = b.sample_id and c.contig = b.contig and c.pos between b.pos and b.end_pos
  group by b.sample_id, b.contig),
whole as (select sample_id, contig, sum(end_pos - pos + 1) as n from fx_ref group by sample_id, contig)
select w.sample_id, w.contig, cast(w.n - coalesce(h.n, 0) as bigint) as n_bases
from whole w left join hidden h on h.sample_id = w.sample_id and h.contig = w.contig where w.n > coalesce(h.n, 0)""",
    "genotype_qc": f"""
with {CELLS}
select contig, pos, count(a0) as n_called, count(*) - count(a0) as n_not_called,
  round(count(a0) / count(*), 6) as call_rate, count(case when a0 <> a1 then 1 end) as n_het,
  count(case when a0 > 0 or a1 > 0 then 1 end) as n_non_ref,
  round(avg(dp), 6) as dp_mean, round(stddev_pop(dp), 6) as dp_stdev, min(dp) as dp_min, max(dp) as dp_max,
  round(avg(gq), 6) as gq_mean, round(stddev_pop(gq), 6) as gq_stdev, min(gq) as gq_min, max(gq) as gq_max
from cells group by contig, pos""",
    "hwe_expected": f"""
with {STATS}, two as (
  select s.contig, s.pos, case when s.alt2 is null then t.hom0 end as n_hom_ref,
    case when s.alt2 is null then t.n_het end as n_het, case when s.alt2 is null then t.hom1 end as n_hom_var
  from fx_sites s join stats t on t.site_id = s.site_id),
n as (select *, n_hom_ref + n_het + n_hom_var as total from two)
select contig, pos, n_hom_ref, n_het, n_hom_var,
  round((2e0 * n_hom_ref + n_het) * (2e0 * n_hom_var + n_het) / nullif((2e0 * total - 1) * total, 0), 6) as het_freq_hwe
from n""",
    "hwe_p_values": f"""
with {STATS}, two as (
  select site_id, t.n_het, t.hom0 + t.n_het + t.hom1 as n, least(2 * t.hom0, 2 * t.hom1) + t.n_het as rare
  from fx_sites s join stats t using (site_id) where s.alt2 is null and t.hom0 + t.n_het + t.hom1 > 0),
h as (select *, unnest(range(rare % 2, rare + 1, 2)) as hets from two),
w as (
  select *, hets * ln(2) - lgamma(hets + 1) - lgamma((rare - hets) / 2 + 1)
    - lgamma(n - hets - (rare - hets) / 2 + 1) as log_p from h),
p as (select *, exp(log_p - max(log_p) over (partition by site_id)) as p from w),
q as (select *, max(case when hets = n_het then p end) over (partition by site_id) as seen from p),
v as (
  select site_id,
    sum(case when abs(p - seen) <= 1e-10 * seen then p / 2 when p < seen then p else 0 end) / sum(p) as two_sided,
    sum(case when hets > n_het then p when hets = n_het then p / 2 else 0 end) / sum(p) as excess
  from q group by site_id)
select s.contig, s.pos, round(v.two_sided, 6) as p_value_hwe, round(v.excess, 6) as p_value_excess_het
from fx_sites s left join v using (site_id)""",
    "join_frequency": """
select s.contig, s.pos, concat_ws(',', s.ref, s.alt, s.alt2) as alleles, f.af as gnomad_af, f.af_nfe as gnomad_nonfin
from fx_sites s left join fx_gnomad f
  on f.contig = s.contig and f.pos = s.pos and f.ref = s.ref and f.alt = s.alt and s.alt2 is null""",
    "clinical_scan": """
select contig, pos, ref, a.alt, concat(clnsig, ',_low') as clnsig, clnrevstat
from fx_clinvar, (select unnest([0, 1]) as nth) n, lateral (select case nth when 0 then fx_clinvar.alt else 'TTTT' end as alt) a
where contig <> 'MT' or pos <= 16569""",
    "score_scan": "select contig, pos, ref, alt, cadd_phred, cadd_raw from fx_cadd where contig <> 'MT' or pos <= 16569",
    "consequence_scan": """
select contig, pos, ref, alt, split_part(consequence, '&', 1) as most_severe, case when has_tc then gene_symbol end as symbol,
  case when has_tc then consequence end as terms from fx_vep
where contig <> 'MT' or pos <= 16569""",
    "join_clinical": """
select s.contig, s.pos, s.ref, s.alt, k.clnsig, k.clnrevstat from fx_sites s
left join fx_clinvar k on k.contig = s.contig and k.pos = s.pos and k.ref = s.ref and k.alt = s.alt""",
    "join_scores": """
select s.contig, s.pos, s.ref, s.alt, c.cadd_phred, c.cadd_raw from fx_sites s
left join fx_cadd c on c.contig = s.contig and c.pos = s.pos and c.ref = s.ref and c.alt = s.alt""",
    "join_consequence": """
select s.contig, s.pos, s.ref, s.alt, split_part(v.consequence, '&', 1) as most_severe
from fx_sites s left join fx_vep v on v.site_id = s.site_id""",
    "flatten_vep": f"""
with {DOCS} select chrom as contig, pos, consequence as "Consequence", impact as "IMPACT", gene_symbol as "SYMBOL",
  gdna as "HGVSg", cdna as "HGVSc", p_nomen as "HGVSp", transcript as transcript_id, cadd_score as "CADD_PHRED",
  cadd_raw as "CADD_RAW", clinvar_sig as "ClinVar_CLNSIG", clinvar_clnrevstat as "ClinVar_CLNREVSTAT" from docs""",
    "annotated_variants": f"""
with {DOCS} select chrom as contig, pos, concat_ws(',', ref, alt, alt2) as alleles,
  concat_ws(',', cast(ac0 as string), cast(ac_total as string), case when alt2 is not null then cast(ac2 as string) end) as ac,
  an_total as an, consequence, gene_symbol as symbol, cadd_score as cadd_phred, clinvar_sig as clnsig,
  gnomad_af, gnomad_nonfin from docs""",
    "first_match_per_key": """
select contig, pos, sample_id, gq, dp from (
  select *, row_number() over (partition by contig, pos order by gq, sample_id) as nth from fx_lgt) where nth = 1""",
    "docs_annotated": f"with {DOCS} select {DOC_FIELDS} from docs",
    "docs_basic": f"""
with {DOCS} select variant_id, chrom, pos, ref, alt, rsids, filters, ac_total as ac, an_total as an, af_total as af,
  hom_count as n_hom from docs""",
    "docs_declared": f"""
with {DOCS} select """ + ", ".join(
        [f"2 * count({c}) as n_{c}" for c in ("variant_id", "chrom", "pos", "ref", "alt", "rsids", "filters")]
        + [f"count({c}) as n_{c}" for c in DOC_FIELDS.split(", ")[7:]]
        + [f"count({c}) as n_{n}" for c, n in
           (("ac_total", "ac"), ("an_total", "an"), ("af_total", "af"), ("hom_count", "n_hom"))]
    ) + " from docs",
    "docs_upsert": f"""
select {_id('')} as variant_id, 'second' as written, cadd_phred as cadd_score from fx_cadd
union all select {_id()}, 'first', cast(null as double) from fx_sites s where s.rsid is not null
  and not exists (select 1 from fx_cadd c where c.contig = s.contig and c.pos = s.pos and c.ref = s.ref and c.alt = s.alt)""",
    "docs_upsert_last": """
with writes as (
  select concat(contig, '-', cast(pos as string)) as variant_id, sample_id, gq,
    row_number() over (partition by contig, pos order by gq desc, sample_id desc) as nth from fx_lgt where l0 = 1)
select variant_id, sample_id, gq from writes where nth = 1
union all select concat(contig, '-', cast(pos as string)), 'none', 0 from fx_sites
where concat(contig, '-', cast(pos as string)) not in (select variant_id from writes)""",
    "docs_last_write": """
select variant_id, sample_id, gq, version from (
  select concat(contig, '-', cast(pos as string)) as variant_id, sample_id, gq,
    cast(gq as bigint) * 100000000 + cast(substr(sample_id, 2) as bigint) as version,
    row_number() over (partition by contig, pos order by gq desc, sample_id desc) as nth from fx_lgt) where nth = 1""",
    "docs_bulk_lines": f"""
with {DOCS} select variant_id, true as is_action, cast(null as bigint) as an, false as writes_nulls from docs
union all select variant_id, false, an_total, true from docs""",
    "report_freq": f"with {DOCS} select {FREQ} from docs",
    "report_fill": f"with {DOCS} select {FILL} from docs",
    "report_clinical": f"with {DOCS} select {CLINICAL} from docs",
    "report_full": f"with {DOCS} select {FILL}, {FREQ}, {CLINICAL} from docs",
    "preview": f"""
with {DOCS} select chrom as contig, pos, concat_ws(',', ref, alt, alt2) as alleles, an_total as an, gnomad_af,
  gnomad_nonfin, consequence from docs
order by case chrom when 'X' then 23 when 'Y' then 24 when 'MT' then 25 else try_cast(chrom as int) end, pos limit 3""",
    "variant_shape": f"with {DOCS} select {SHAPE} from docs",
    "variant_shape_basic": f"with {DOCS} select {SHAPE} from docs",
    "region_lookup": f"""
with {DOCS} select {SHAPE} from docs where chrom = '7' and pos between 150000 and 750000
order by docs.pos, docs.ref, docs.alt limit 10000""",
    "region_count": "select count(*) as n_variants from fx_sites where contig = '7' and pos between 150000 and 750000",
    "region_counts": """
with regions as (select gene_id as region_id, chrom, start, stop from fx_genes
  union all select transcript_id, chrom, start, stop from fx_transcripts
  union all select region_id, chrom, start, stop from fx_regions)
select r.region_id, count(s.site_id) as n_variants from regions r
left join fx_sites s on s.contig = r.chrom and s.pos between r.start and r.stop group by r.region_id""",
    "variants_by_gene": f"""
with {DOCS}, hits as (
  select g.gene_id, row_number() over (partition by g.gene_id order by d.pos, d.ref, d.alt) as rank, d.*
  from docs d join fx_genes g on g.chrom = d.chrom and d.pos between g.start and g.stop)
select gene_id, rank, {SHAPE} from hits where rank <= 10000""",
    "variants_by_transcript": f"""
with {DOCS}, hits as (
  select g.transcript_id, row_number() over (partition by g.transcript_id order by d.pos, d.ref, d.alt) as rank,
    d.variant_id, d.an_total as an
  from docs d join fx_transcripts g on g.chrom = d.chrom and d.pos between g.start and g.stop)
select * from hits where rank <= 10000""",
    "variants_by_region": f"""
with {DOCS}, hits as (
  select g.region_id, row_number() over (partition by g.region_id order by d.pos, d.ref, d.alt) as rank, d.*
  from docs d join fx_regions g on g.chrom = d.chrom and d.pos between g.start and g.stop)
select region_id, rank, {SHAPE} from hits where rank <= 10000""",
    "lookup_by_id": f"""
with {KEYS} select variant_id, chrom, pos, ref, alt from keys where variant_id = '2-7920-C-CG'""",
    "lookup_by_rsid": f"""
with {KEYS} select variant_id, chrom, pos, ref, alt from keys where rsid = 'rs100006'""",
    "first_variants_by_gene": f"""
with {KEYS}, hits as (
  select g.gene_id, row_number() over (partition by g.gene_id order by d.pos, d.ref, d.alt) as rank, d.variant_id
  from keys d join fx_genes g on g.chrom = d.chrom and d.pos between g.start and g.stop)
select * from hits where rank <= 5""",
    "lookup_many": f"""
with {KEYS}, hits as (
  select q.query, k.* from fx_requests q join keys k
    on case when regexp_full_match(q.query, 'rs[0-9]+') then k.rsid = q.query else k.variant_id = q.query end),
n as (select query, count(*) as n_hits from hits group by query)
select q.query, coalesce(n.n_hits, 0) as n_hits, h.variant_id, h.chrom, h.pos, h.ref, h.alt
from fx_requests q left join n on n.query = q.query left join hits h on h.query = q.query and n.n_hits = 1""",
    "gvcf_scan": """
select sample_id, raw_contig, pos, ref, alts, case when gt <> './.' then gt end as gt, gq, dp from fx_gvcf""",
    "sites_scan": """
select contig, pos, concat_ws(',', ref, alt, alt2) as alleles, rsid as rsids,
  case site_id % 3 when 0 then '' when 2 then 'q10,s50' end as filters,
  cast(site_id % 8 as double) as af, cast(null as double) as af_nfe
from fx_sites where contig <> 'MT' or pos <= 16569""",
    "docs_filters": f"""
select {_id()} as variant_id, case when s.pos % 3 = 0 then 'q10,s50' else '' end as filters from fx_sites s""",
    "autocomplete_position": f"""
with {KEYS} select variant_id, chrom, pos, ref, alt from keys where starts_with(variant_id, '7-39') order by variant_id limit 1000""",
    "autocomplete": f"""
with {KEYS} select variant_id, chrom, pos, ref, alt from keys
where starts_with(variant_id, '7-1') or rsid = '7-1' order by variant_id limit 5""",
    "autocomplete_rsid": f"""
with {KEYS} select variant_id, chrom, pos, ref, alt from keys
where starts_with(variant_id, 'rs100006') or rsid = 'rs100006' order by coalesce(rsid = 'rs100006', false) desc, variant_id limit 5""",
    "genome_check": """
with asked as (
  select transcript_id,
    case when start < 240001 then 'cohort' when start < 300001 then 'gnomad_r4' else 'unknown' end as dataset_id
  from fx_transcripts)
select transcript_id, dataset_id,
  case dataset_id when 'cohort' then 'GRCh37' when 'gnomad_r4' then 'GRCh38' end as dataset_genome,
  dataset_id = 'cohort' as valid from asked""",
    "gene_summary": f"""
with {DOCS} select g.gene_id, g.symbol, max(d.af_total) as max_af, count(d.variant_id) as n_variants,
  cast(coalesce(sum(d.ac_total), 0) as bigint) as ac, cast(coalesce(sum(d.hom_count), 0) as bigint) as n_hom, {IMPACTS}
from fx_genes g left join docs d on d.chrom = g.chrom and d.pos between g.start and g.stop
group by g.gene_id, g.symbol""",
    "contig_rename": """
select raw_contig, contig, n, case contig when 'X' then 22 when 'Y' then 23 when 'MT' then 24
  else try_cast(contig as int) - 1 end as contig_index
from (select raw_contig, replace(replace(raw_contig, 'chrM', 'MT'), 'chr', '') as contig, count(*) as n
      from fx_gvcf group by raw_contig)""",
    "contig_filter": """
with r as (select replace(raw_contig, 'chr', '') as contig, 1 as v from fx_gvcf where raw_contig <> 'chrM'
  union all select contig, 0 from fx_ref where contig <> 'MT')
select contig, count(*) as n_records, cast(sum(v) as bigint) as n_variants from r group by contig""",
    "unify_alleles": f"with {MERGE.format(first_run='0')} select contig, pos, alleles from lists",
    "combine_calls": f"with {MERGE.format(first_run='0')} {CALLS}",
    "combine_incremental": f"with {MERGE.format(first_run='min(sidx % 2)')} {CALLS}",
    "combined_samples": "select sample_id from fx_gvcf union select sample_id from fx_ref",
    "combined_reference_bases": """
with hidden as (
  select b.contig, count(*) as n from fx_ref b
  join fx_lgt c on c.sample_id = b.sample_id and c.contig = b.contig and c.pos between b.pos and b.end_pos
  group by b.contig)
select b.contig, cast(sum(b.end_pos - b.pos + 1) - coalesce(any_value(h.n), 0) as bigint) as n_bases,
  count(distinct b.sample_id) as n_samples
from fx_ref b left join hidden h on h.contig = b.contig where b.contig <> 'MT' group by b.contig""",
    "meta_join": """
select p.sample_id, m.sex, m.age, m.date_seq, m.run_id, m.care_site, m.health_status
from fx_samples p left join fx_meta m on m.sample_id = p.sample_id""",
    "panels_per_sample": """
select p.sample_id, string_agg(n.panel, ';' order by n.panel) as panels
from fx_samples p left join fx_panels n on n.sample_id = p.sample_id group by p.sample_id""",
    "panel_orphans": """
select n.sample_id, n.panel from fx_panels n
where not exists (select 1 from fx_meta m where m.sample_id = n.sample_id)""",
    "id_typos": """
select distinct n.sample_id, m.sample_id as suggestion from fx_panels n, fx_meta m
where levenshtein(n.sample_id, m.sample_id) = 1
  and not exists (select 1 from fx_meta k where k.sample_id = n.sample_id)""",
    "date_normalize": """
select sample_id, date_seq, cast(cast(try_strptime(date_seq, '%-m/%-d/%y') as date) as string) as iso_date,
  try_strptime(date_seq, '%-m/%-d/%y') is null as date_seq_bad from fx_meta""",
    "hpo_terms": """
select h.sample_id, h.hpo_id, t.hpo_term, t.hpo_version
from fx_hpo h left join (select * from fx_hpo_terms where hpo_version = 'v2') t on t.hpo_id = h.hpo_id""",
    "hpo_terms_version": """
select h.sample_id, h.hpo_id, t.hpo_term, t.hpo_version
from fx_hpo h left join (select * from fx_hpo_terms where hpo_version = 'v1') t on t.hpo_id = h.hpo_id""",
    "ingested_files": "select distinct gvcf from fx_manifest where status = 'completed'",
    "new_files": """
select gvcf from fx_file_status except select gvcf from fx_manifest where status = 'completed'""",
    "latest_completed_run": f"""
with {RUNS} select seq, run_id, status from runs where status = 'completed' order by seq desc limit 1""",
    "latest_in_progress_run": f"""
with {RUNS} select seq, run_id, status from runs where status = 'in_progress' order by seq desc limit 1""",
    "next_run_id": """
select concat('2026-03-11_run', lpad(cast(coalesce(max(try_cast(substr(run_id, 15) as int)), 0) + 1 as string), 3, '0'))
  as run_id from fx_manifest where starts_with(run_id, '2026-03-11_run')""",
    "next_run_ids": """
select substr(run_id, 1, 10) as run_date,
  concat(substr(run_id, 1, 10), '_run', lpad(cast(max(try_cast(substr(run_id, 15) as int)) + 1 as string), 3, '0')) as run_id
from fx_manifest group by substr(run_id, 1, 10)""",
    "run_states": "select distinct run_id, seq * 2 as seq, status from fx_manifest",
    "ingest_summary": """
select count(*) as total, count(case when status <> 'failed' then 1 end) as successful,
  count(case when status = 'done' then 1 end) as new, count(case when status = 'skipped' then 1 end) as skipped,
  count(case when status = 'failed' then 1 end) as failed,
  round(avg(case when status = 'done' then seconds end), 6) as mean_seconds from fx_file_status""",
    "first_failures": """
select gvcf, error from fx_file_status where status = 'failed' order by gvcf limit 20""",
}

# The indexed and the plain form answer alike.
ORACLE["lookup_many_indexed"] = ORACLE["lookup_many"]
ORACLE["autocomplete_indexed"] = ORACLE["autocomplete_rsid"]


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLE.items()}
