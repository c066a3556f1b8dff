"""Table schemas as DDL strings, the form Spark readers take."""

LOCAL_CALL = "struct<alleles:array<int>,phased:boolean>"

SITES = "contig string, pos int, alleles array<string>, rsids array<string>"
CALLS = f"contig string, pos int, sample_id string, LGT {LOCAL_CALL}, LA array<int>, gq int, dp int"
REF_BLOCKS = "sample_id string, contig string, pos int, end_pos int, gq int, dp int"
SAMPLES = "sample_id string"

# One parsed gVCF line.
RECORDS = (
    "sample_id string, raw_contig string, pos int, end_pos int, rsids array<string>, "
    f"ref string, alts array<string>, LGT {LOCAL_CALL}, gq int, dp int"
)

# The consequence record as the external annotator reports it.
CONSEQUENCE = (
    "struct<input:string,most_severe_consequence:string,"
    "transcript_consequences:array<struct<consequence_terms:array<string>,impact:string,"
    "gene_symbol:string,hgvsg:string,hgvsc:string,hgvsp:string,transcript_id:string,"
    "cadd_phred:double,cadd_raw_rankscore:double,canonical:int>>,"
    "intergenic_consequences:array<struct<consequence_terms:array<string>,impact:string>>,"
    "custom_annotations:struct<ClinVar:array<struct<allele:string,"
    "fields:struct<CLNSIG:string,CLNREVSTAT:string>>>>>"
)

# Annotation tables by variant key.
CLINICAL = "contig string, pos int, ref string, alt string, clnsig string, clnrevstat string"
SCORES = "contig string, pos int, ref string, alt string, cadd_phred double, cadd_raw double"
CONSEQUENCES = f"contig string, pos int, ref string, alt string, vep {CONSEQUENCE}"
FREQUENCY = "contig string, pos int, ref string, alt string, alleles array<string>, af double, af_nfe double"

# Run log: one row per event, the last event of a run is its state.
RUN_EVENTS = (
    "run_id string, seq long, status string, cohort_path string, temp_path string, "
    "event_at timestamp, n_samples long"
)
RUN_FILES = "run_id string, gvcf string"

# The JSON run manifest.
MANIFEST = (
    "version int, runs array<struct<run_id:string,vds_path:string,temp_path:string,status:string,"
    "started_at:string,gvcfs:array<string>,completed_at:string,n_samples:long>>"
)

# Where each rsid stands.
RSID_INDEX = "rsid string, variant_id string, chrom string, pos int, ref string, alt string"

# The declared mapping of the document table, 27 fields, both export paths.
VARIANT_DOCS = (
    "variant_id string, chrom string, pos int, ref string, alt string, "
    "rsids array<string>, filters array<string>, "
    "ac_total long, an_total long, af_total double, hom_count long, "
    "ac long, an long, af double, n_hom long, "
    "gene_symbol string, consequence string, impact string, gdna string, cdna string, "
    "p_nomen string, transcript string, cadd_score double, "
    "clinvar_sig string, clinvar_clnrevstat string, gnomad_af double, gnomad_nonfin double"
)
