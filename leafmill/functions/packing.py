"""Greedy packing of text into token budgets: paragraphs, then sentences, then words.

A greedy fold is sequential within a block; as a higher-order aggregate it would copy its
growing array at each item, so it is one linear pass in an Arrow-batched function."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .text import JS_WS, PROTECTED

_WS = JS_WS.replace(r"\x0B", "\x0b")
_TRIM = re.compile(rf"^{_WS}+|{_WS}+\Z")
_END = re.compile(rf"([.!?]){_WS}+(?=[A-Z])")


def count(text: str) -> int:
    return -(-(len(text) + sum(c > "\uffff" for c in text)) // 4)


def trim(text: str) -> str:
    return _TRIM.sub("", text)


def split_sentences(text: str) -> list[str]:
    for i, word in enumerate(PROTECTED):
        text = re.sub(re.escape(word), f"\ufdd4{chr(0xFDD8 + i)}", text, flags=re.I | re.A)
    text = re.sub(r"(?<![0-9])([0-9]++)\.([0-9]++)", "\\1\ufdd5\\2", text)
    out = []
    for part in _END.sub("\\1\ufdd6", text).split("\ufdd6"):
        part = trim(part)
        for i, word in enumerate(PROTECTED):
            part = part.replace(f"\ufdd4{chr(0xFDD8 + i)}", word)
        if part:
            out.append(part.replace("\ufdd5", "."))
    return out


def pack(items: list[str], budget: int, glue: str, cost: int, first_cost: int, oversize) -> list[str]:
    """Items joined by glue up to the budget; an item beyond it is given to oversize alone."""
    out, held, used = [], "", 0
    for item in items:
        n = count(item)
        if n > budget and oversize:
            if held:
                out.append(trim(held))
            held, used = "", 0
            out += oversize(item)
            continue
        if held and used + n + cost > budget:
            out.append(trim(held))
            held, used = "", 0
        held, used = (held + glue + item, used + n + cost) if held else (item, n + first_cost)
    if trim(held):
        out.append(trim(held))
    return out


def split_block(text: str, breadcrumb_tokens: int, target: int = 512) -> list[str]:
    budget = target - breadcrumb_tokens
    if count(text) <= budget:
        return [text]
    words = lambda s: pack([w for w in re.split(f"{_WS}+", s) if w], budget, " ", 1, 1, None)
    by_sentence = lambda s: pack(split_sentences(s), budget, " ", 1, 1, words)
    paragraphs = re.split(r"\n\n+", text)
    return pack(paragraphs, budget, "\n\n", 2, 2, by_sentence) if len(paragraphs) > 1 else by_sentence(text)


def split_block_udf(target: int = 512):
    @F.pandas_udf(ArrayType(StringType()))
    def run(text: pd.Series, breadcrumb_tokens: pd.Series) -> pd.Series:
        return pd.Series([split_block(t or "", int(b), target) for t, b in zip(text, breadcrumb_tokens, strict=True)])

    return run


def accumulate(items: list[str], budget: int, cost: int) -> list[list[str]]:
    """Groups of items; the separator costs from the second item on, a first item may exceed the budget."""
    out: list[list[str]] = []
    used = 0
    for item in items:
        n = count(item)
        if out and out[-1] and used + n + cost <= budget:
            out[-1].append(item)
            used += n + cost
        else:
            out.append([item])
            used = n
    return out
