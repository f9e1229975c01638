"""The operators' queries and oracles."""

from __future__ import annotations

from . import alignment, chat, compression, decontaminate, fillmiddle, jaccard, linededup, mixing, pages, rules, simhash, suffixes, tokens

MODULES = (linededup, jaccard, tokens, compression, pages, mixing, suffixes, rules, chat, decontaminate, simhash, fillmiddle, alignment)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
