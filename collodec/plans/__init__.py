from .materialize import Workspace
from .pipeline import Run, collocations, run, score_pairs

__all__ = ["Run", "Workspace", "collocations", "run", "score_pairs"]
