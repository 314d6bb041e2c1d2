"""Fixed values. Results are only right when these are exactly as stated.

Nothing here is tuned: each value is part of the data contract of the tables
this package produces, so change one only together with the stored tables.
"""

# Characters removed from the edges of a text before it is measured or
# compared: the 29 code points Unicode-aware string stripping treats as space.
EDGE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Inclusive length band of a usable instruction, in code points.
MIN_INSTRUCTION_CHARS = 20
MAX_INSTRUCTION_CHARS = 2500

# An instruction holding any of these (case-insensitive substring) is dropped.
REFUSAL_PHRASES = (
    "as an ai",
    "i cannot fulfill",
    "i'm sorry",
    "i am sorry",
    "i can't fulfill",
    "language model",
    "openai",
    "chatgpt",
    "抱歉",
    "无法回答",
    "作为人工智能",
    "evolve this prompt",
    "sorry, but i cannot",
)

# Sample sizes and seed.
SFT_SAMPLE_SIZE = 20000
SFT_SAMPLE_SEED = 42
PREFERENCE_SAMPLE_SIZE = 10000
HOLDOUT_FRACTION = 0.05

# System prompts.
CODING_SYSTEM_PROMPT = (
    "You are a helpful coding assistant. For each request, provide a clear solution with "
    "step-by-step explanation, comments in code, and handle edge cases. Output the final code in a code block."
)
GENERIC_SYSTEM_PROMPT = "You are a helpful assistant."

# Text layout of a chat turn and of a judge request.
CHAT_TURN_START = "<|im_start|>"
CHAT_TURN_END = "<|im_end|>"
STOP_STRINGS = ("<|endoftext|>", "<|im_end|>")
JUDGE_TEXT_CHARS = 8000
JUDGE_SUFFIX = "Score:"

# Generation settings.
CANDIDATES_PER_PROMPT = 4
JUDGE_BATCH_SIZE = 256
MAX_REQUESTS_IN_FLIGHT = 64
