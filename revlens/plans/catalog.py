"""Import every catalog module and expose the two dictionaries of the driver contract."""

from __future__ import annotations

from revlens.plans import q_corpus, q_embed, q_eval, q_features, q_io, q_learn, q_sentences, q_stream, q_text  # noqa: F401
from revlens.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
