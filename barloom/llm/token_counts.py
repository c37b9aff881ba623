"""Token counts per section from one encoding of the whole document.

A document is encoded once. Every token's byte span is known, as tokens of a byte-level
vocabulary join to the text's bytes; spans become character spans and are joined with the
sections' character spans by binary search. A token within one section counts there. One
that crosses a boundary goes by a rule: ``majority`` to the section that holds most of its
characters (the earlier of equals), ``start`` to the section of its first character, and
``split`` in parts in proportion to its characters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import fields, map_arrow, read, text_bytes

#: A public byte-level vocabulary, `token rank` lines with the token in base64.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that cuts text before byte pairs merge, public with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("majority", "start", "split")

#: What a section may be: a line, or a line's sentence up to `.`, `!` or `?` and white space.
UNITS = ("sentence", "line")

_NEWLINE, _SPACE = 10, 32
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


@lru_cache(maxsize=1)
def _encoding(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def section_ends(raw: np.ndarray, unit: str = "sentence") -> np.ndarray:
    """Byte ends of a text's sections, each with the white space that closes it; an empty text has one empty section."""
    newline = raw == _NEWLINE
    if unit == "line":
        ends = np.flatnonzero(newline) + 1
    else:
        space = newline | (raw == _SPACE)
        closed = space.copy()
        closed[1:] &= _STOPS[raw[:-1]] | newline[1:]
        closed[:1] &= newline[:1]
        # white space after a closing one belongs to the same section
        runs = np.flatnonzero(space & ~np.append(space[1:], False))
        total = np.concatenate(([0], np.cumsum(closed)))
        starts = np.flatnonzero(space & ~np.concatenate(([False], space[:-1])))
        ends = runs[total[runs + 1] > total[starts]] + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.append(ends, len(raw))


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and tokens that cross into or out of it.

    ``starts`` and ``ends`` are character spans of the tokens, ``bounds`` the n + 1 character
    bounds of the sections. A token that holds part of a character spans the whole of it.
    """
    n = len(bounds) - 1
    first = np.clip(np.searchsorted(bounds, starts, "right") - 1, 0, n - 1)
    last = np.clip(np.searchsorted(bounds, ends, "left") - 1, 0, n - 1)
    inner = last == first
    count = np.bincount(first[inner], minlength=n).astype(np.float64)
    two = np.flatnonzero(last == first + 1)
    a, b = first[two], last[two]
    left, right = bounds[b] - starts[two], ends[two] - bounds[b]
    crossed = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    if rule == "split":
        count += np.bincount(a, left / (left + right), n) + np.bincount(b, right / (left + right), n)
    else:
        count += np.bincount(a if rule == "start" else np.where(right > left, b, a), minlength=n)
    for i in np.flatnonzero(last > first + 1).tolist():
        own = np.arange(first[i], last[i] + 1)
        held = np.minimum(bounds[own + 1], ends[i]) - np.maximum(bounds[own], starts[i])
        crossed[own[held > 0]] += 1
        if rule == "split":
            count[own] += held / held.sum()
        else:
            count[own[0] if rule == "start" else own[np.argmax(held)]] += 1
    return count, crossed


def section_tokens(docs: DataFrame, rule: str = "majority", unit: str = "sentence", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document and section: all columns but ``text``, then ``section`` (from 0),
    ``start_char``, ``end_char``, ``n_tokens`` (double under ``split``, else long) and ``n_crossing``.

    Sections are sentences or lines (``UNITS``), each with the white space that closes it. The sections' counts add up to the document's
    tokens. A null or empty text has one empty section without tokens. Repeated rows are
    counted row by row; columns of these five names are replaced. The vocabulary file is read
    on the driver and sent to the tasks.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    docs = docs.drop("section", "start_char", "end_char", "n_tokens", "n_crossing")
    with open(vocabulary, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [c for c in docs.columns if c != "text"]
    kind = np.float64 if rule == "split" else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _encoding(held.value)

        def out(batch, rows, parts):
            own = [batch.column(c).take(pa.array(np.concatenate(rows))) for c in names]
            return pa.RecordBatch.from_arrays([*own, *[pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]], names=[*names, "section", "start_char", "end_char", "n_tokens", "n_crossing"])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows, parts, held_rows = [], [], 0
            for i, text in enumerate(batch.column("text")):
                raw = data[offsets[i] : offsets[i + 1]]
                tokens = sizes[encoding.encode_ordinary(text.as_py())] if len(raw) else np.zeros(0, np.int64)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                ends = np.cumsum(tokens)
                bounds = np.concatenate(([0], chars[section_ends(raw, unit)]))
                starts = ends - tokens
                # a token that begins within a character begins, as characters go, with it
                begin = chars[starts] - (((raw[starts] & 0xC0) == 0x80) if len(starts) else 0)
                count, crossed = attribute(begin, chars[ends], bounds, rule)
                rows.append(np.full(len(count), i))
                parts.append((np.arange(len(count)), bounds[:-1], bounds[1:], count.astype(kind), crossed))
                held_rows += len(count)
                if held_rows > 50_000:
                    yield out(batch, rows, parts)
                    rows, parts, held_rows = [], [], 0
            if rows:
                yield out(batch, rows, parts)

    count = "double" if rule == "split" else "long"
    schema = ", ".join([*fields(docs, *names), f"section long, start_char long, end_char long, n_tokens {count}, n_crossing long"])
    return map_arrow(docs, run, schema)


def op10_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every sentence of every document, from one encoding of the whole document."""
    return section_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"))
