"""Column names of the tables and formats."""

# Column names of the formats, in the order of their fields.
HIT_FIELDS = [
    "query_id", "subject_id", "pct_identity", "aln_len", "mismatches", "gap_openings", "q_start", "q_end", "s_start", "s_end", "evalue", "bitscore", "subject_sequence",
]
RPS_FIELDS = [*HIT_FIELDS[:12], "subject_title"]
DOMAIN_FIELDS = [
    "species", "session_ordinal", "program", "version", "database", "score_matrix", "evalue_threshold", "query_id", "seq_type", "seq_length", "definition", "chromosome",
    "start", "end", "hit_type", "pssm_id", "from", "to", "evalue", "bitscore", "accession", "domain", "incomplete", "superfamily_pssm_id",
]

HIT_DOUBLES = ["pct_identity", "evalue", "bitscore"]
HIT_LONGS = ["aln_len", "mismatches", "gap_openings", "q_start", "q_end", "s_start", "s_end"]
