from .tables import RunPaths, write_pairs, write_scores, write_totals, write_unigrams

__all__ = ["RunPaths", "write_pairs", "write_scores", "write_totals", "write_unigrams"]
