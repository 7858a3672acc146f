from shelfsense.streaming.jobs import score_stream, label_count_stream

__all__ = ["score_stream", "label_count_stream"]
