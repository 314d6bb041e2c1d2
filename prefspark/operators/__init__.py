from prefspark.operators.cleaning import (
    clean,
    clean_report,
    clean_tally,
    dedup_exact,
    kept_instructions,
    report_from_tally,
)
from prefspark.operators.inference import (
    GenerationSettings,
    generate,
    generate_candidates,
    generate_remote,
    judge,
)
from prefspark.operators.leakage import instruction_key, unseen
from prefspark.operators.metrics import distinct_keys, request_metrics, stage_metrics
from prefspark.operators.pairs import (
    flatten_responses,
    pairs_from_scores,
    pairs_passthrough,
    regroup_scores,
)
from prefspark.operators.sampling import (
    head_n,
    holdout_flag,
    holdout_split,
    number_copies,
    sample_n,
)
from prefspark.operators.usedkeys import UsedKeys

__all__ = [
    "UsedKeys",
    "GenerationSettings",
    "clean",
    "clean_report",
    "clean_tally",
    "dedup_exact",
    "distinct_keys",
    "flatten_responses",
    "generate",
    "generate_candidates",
    "generate_remote",
    "head_n",
    "holdout_flag",
    "holdout_split",
    "instruction_key",
    "judge",
    "kept_instructions",
    "number_copies",
    "pairs_from_scores",
    "pairs_passthrough",
    "regroup_scores",
    "report_from_tally",
    "request_metrics",
    "sample_n",
    "stage_metrics",
    "unseen",
]
