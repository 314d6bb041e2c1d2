from prefspark.plans.answers import answer_all, answer_seeds, answer_seeds_remotely, seed_instructions
from prefspark.plans.curation import clean_corpus, sample_seeds
from prefspark.plans.preference import (
    pick_prompts,
    preference_pairs,
    score_candidates,
    write_candidates,
    write_pairs,
)

__all__ = [
    "answer_all",
    "answer_seeds",
    "answer_seeds_remotely",
    "clean_corpus",
    "pick_prompts",
    "preference_pairs",
    "sample_seeds",
    "score_candidates",
    "seed_instructions",
    "write_candidates",
    "write_pairs",
]
