"""Token counts of a byte-level BPE, most of them without merging anything."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.llm.batches import starts, text_slices
from linkseek.llm.merges import PairTable, merge_words

LIMIT = 1024
# Pre-tokens whose counts one Python worker remembers.
REMEMBERED = 1 << 18

# The pre-tokenizer's alternatives, with its letter, number and space classes open.
_PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+"
    r"| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
)


def byte_characters() -> dict[str, int]:
    """The vocabulary's printable stand-ins of the 256 bytes: a byte that is a visible Latin-1
    character stands for itself, the others follow from code point 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _classes(last: int) -> dict[str, str]:
    """Letters, numbers and spaces up to a code point, as ranges for the faster regex engine."""
    points = [x for x in range(last + 1) if not 0xD800 <= x < 0xE000]
    everything = "".join(map(chr, points))

    def ranges(pattern: str) -> str:
        found = (m[0] for m in regex.finditer(pattern, everything))
        return "".join(f"\\U{ord(x[0]):08x}-\\U{ord(x[-1]):08x}" for x in found)

    return {"letters": ranges(r"\p{L}+"), "numbers": ranges(r"\p{N}+"), "spaces": ranges(r"\s+")}


class Merges:
    """A vocabulary's merges over bytes, and the strings that they turn into one token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = byte_characters()
        as_bytes = lambda token: bytes(byte_of[c] for c in token)
        symbol = {bytes([b]): b for b in range(256)}
        table = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            into = symbol.setdefault(a + b, len(symbol))
            table.setdefault((symbol[a], symbol[b]), (rank, into))
        self.table = PairTable(table)
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.whole = self.prove([as_bytes(token) for token in spec["model"]["vocab"]])

    def count(self, strings: list[bytes]) -> list[int]:
        """Tokens of each string once its pairs are merged."""
        symbols = np.frombuffer(b"".join(strings), np.uint8).astype(np.int32)
        _, start = merge_words(symbols, starts([len(x) for x in strings]), self.table)
        return np.diff(start).tolist()

    def prove(self, strings: list[bytes]) -> frozenset[str]:
        """Those strings that encode alone as one token, found by merging each; text only."""
        alone = [s.decode("utf-8", "ignore") for s, n in zip(strings, self.count(strings)) if n == 1]
        return frozenset(alone) & frozenset(s.decode("utf-8", "replace") for s in strings)


@lru_cache(maxsize=4)
def load_merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Tokens of texts. Kept by a Python worker from task to task."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.known = dict.fromkeys(merges.whole, 1)
        # Texts of few different characters are split faster by the classes of those alone.
        self.split = {
            last: re.compile(_PRE_TOKEN.format(**_classes(last))).findall
            for last in (0xFF, 0xFFFF, sys.maxunicode)
        }
        self.special = re.compile("|".join(map(re.escape, merges.specials)) or r"(?!)").split

    def pre_tokens(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            last = 0xFF
        except UnicodeEncodeError:
            wide = len(text.encode("utf-16-le")) > 2 * len(text)
            last = sys.maxunicode if wide else 0xFFFF
        return self.split[last](text)

    def count(self, texts: list[str]) -> list[int]:
        """A proven string counts one by look-up; unseen others are merged, all at once."""
        spans = [self.special(text) for text in texts]
        parts = [[p for span in x for p in self.pre_tokens(span)] for x in spans]
        rest = list(set().union(*parts).difference(self.known))
        if len(self.known) + len(rest) > len(self.merges.whole) + REMEMBERED:
            self.known = dict.fromkeys(self.merges.whole, 1)
            rest = list(set().union(*parts).difference(self.known))
        self.known.update(zip(rest, self.merges.count([x.encode() for x in rest])))
        known = self.known.__getitem__
        return [len(x) - 1 + sum(map(known, p)) for x, p in zip(spans, parts)]


_WORKER: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(`doc_id`, `n_bytes`, `n_tokens`, `over_limit`), a row per row of `docs`.

    Counts are those of the tokenizer file at `path`, read on the driver: a special string in a
    text is one token, the text between is split into pre-tokens, and each is merged alone. The
    vocabulary strings that merging proves to be one token count as one without merging; the
    rest is merged, with its counts remembered up to a bound. A null text is empty and has no
    tokens; a null `doc_id` stays; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_merges(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKER:
            _WORKER[path] = Counter(shared.value)
        for batch, texts in text_slices(batches):
            n_tokens = np.array(_WORKER[path].count([x.decode("utf-8", "replace") for x in texts]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(x) for x in texts], pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array(n_tokens > limit, pa.bool_()),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
