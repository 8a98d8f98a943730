"""Explicit schemas of every source: nothing is inferred, so optional fields don't come and go."""

GROUP = "query string, positive array<string>, negative array<string>"
ITEM = "item_id string, group_id string, role string, idx int, source string"
CACHE_LINE = "source_idn string, idn string, msa string, msa_raw string"
FAQ = "Question string, Answer string, evidence string, reference string, Question_cluster array<string>, file_name string, skill string"
TURN = "turn int, role string, row_id bigint, content string, content_zh string, content_msa string, content_msa_filled string"
DIALOGUE = f"dialogue_id bigint, turns array<struct<{TURN.replace(' ', ': ').replace(',:', ',')}>>"
FAILED = "item_id string, role string, source_idn string, msa string, hard_errors array<string>, hard_warnings array<string>"
QA = "hard_pass boolean, hard_errors array<string>, hard_warnings array<string>, script_ratio double, latin_tokens array<string>"
PER_QUERY = "array<struct<cluster_id: int, query: string, `recall@1`: double, `recall@3`: double, `recall@5`: double, pos_rank: int, top10_indices: array<int>>>"
MODE = f"struct<mode: string, eval_sec: double, summary: map<string, double>, per_query: {PER_QUERY}>"
REPORT = f"eval_set string, num_queries int, models map<string, struct<path: string, backend: string, device: string, modes: map<string, {MODE}>>>"
FILL = "cluster_id string, dialogue_id bigint, cluster_status string, turns array<struct<turn: int, role: string, content_msa: string, content_msa_filled: string>>"
