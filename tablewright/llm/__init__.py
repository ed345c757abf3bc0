"""Operators for building training corpora, with their registered queries."""

from tablewright.llm import (  # noqa: F401
    bpe,
    exactdedup,
    hardneg,
    license,
    linededup,
    merkle,
    mixing,
    quality_model,
    rules,
    sharding,
    simhash,
    spelling,
    urlfilter,
)
from tablewright.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
