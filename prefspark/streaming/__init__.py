from prefspark.streaming.jsonl import stream_jsonl

__all__ = ["stream_jsonl"]
