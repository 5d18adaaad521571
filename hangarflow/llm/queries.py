"""The registered queries of the operators, and their SQL answers."""

from hangarflow.llm.common import QUERIES, SQL
from hangarflow.llm import bpe, chat, collocations, decontam, hamming, langid, lexical, licenses, linededup, longrepeats, minhash, mixing, toxicity  # noqa: F401

__all__ = ["QUERIES", "SQL"]
