from tessera.streaming.scoring import score_stream

__all__ = ["score_stream"]
