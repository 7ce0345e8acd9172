"""Token counts of whole texts by a byte-level BPE of the ``tokenizers`` library.

Boundaries. The vocabulary's pre-tokeniser never lets a match run from a
non-space character into white space, and no special token holds white space.
So the place before a space or newline that follows a visible ASCII character
(or a Latin-1 letter) is a token boundary whatever stands around it: a *stable*
boundary, at which counts add up.

* Huge documents are encoded in overlapping chunks with offsets. Neighbouring
  encodings are spliced at the first stable boundary inside the overlap that
  both of them have; if there is none, the overlap is widened (and, when it
  reaches the chunk's start, the chunk) and encoded again.
* Other documents are cut at all stable boundaries; of equal pieces in a batch
  the library encodes one, and a bounded table remembers the counts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .textvec import T_EXACT, U, buffers, pieces, span_hashes

TOKENIZER = "byte_bpe_50k.json"
LONG_BYTES = 1 << 15  # longer documents go through overlapping chunks
CHUNK, OVERLAP = 1 << 13, 256  # characters
LIMIT = 1024
REMEMBERED = 1 << 20  # piece counts kept per task
# A stable boundary lies after the first character of a match.
_STABLE = re.compile(r"[!-~À-ÿ](?=[ \n])")
_tokenizers: dict = {}


def tokenizer(name: str):
    if name not in _tokenizers:
        from tokenizers import Tokenizer
        if "/" not in name:
            import public_tokenizers
            name_path = public_tokenizers.path(name)
        else:
            name_path = name
        t = Tokenizer.from_file(name_path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[name] = t
    return _tokenizers[name]


def count_chunked(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, from overlapping chunks spliced at stable common boundaries."""
    def starts(lo, hi):
        return np.array([o[0] + lo for o in tok.encode(text[lo:hi], add_special_tokens=False).offsets] or [lo])

    total, lo, hi, counted = 0, 0, min(chunk, len(text)), 0
    here = starts(lo, hi)
    while hi < len(text):
        wide = overlap
        while True:
            nxt = hi - wide
            if nxt <= counted:  # the overlap reached the chunk's start: a longer chunk
                hi = min(len(text), hi + (hi - lo))
                here, wide = starts(lo, hi), overlap
                if hi == len(text):
                    break
                continue
            end = min(len(text), nxt + chunk + wide)
            there = starts(nxt, end)
            common = np.intersect1d(here, there)
            at = [m.end() for m in _STABLE.finditer(text, nxt, hi)]
            common = common[(common > nxt) & np.isin(common, at)]
            if len(common):
                p = int(common[0])
                total += int(((here >= counted) & (here < p)).sum())
                lo, hi, counted, here = nxt, end, p, there
                break
            wide *= 2
    return total + int((here >= counted).sum())


class PieceCounter:
    """Counts by stable pieces; equal pieces are encoded once."""

    def __init__(self, tok, remembered: int = REMEMBERED):
        self.tok, self.most = tok, remembered
        self.keys, self.counts = np.empty(0, U), np.empty(0, np.int64)

    def count(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data), bool)
        if len(data) > 1:
            gap = (data == 32) | (data == 10)
            seen = (data >= 33) & (data <= 126)
            seen[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)
            cut[1:] = gap[1:] & seen[:-1]
        heads = off[:-1][np.diff(off) > 0]
        cut[heads] = True
        s = np.flatnonzero(cut)
        if not len(s):
            return np.zeros(len(off) - 1, np.int64)
        e = np.append(s[1:], len(data))
        keys, first, back = np.unique(span_hashes(data, s, e, T_EXACT), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        n = np.zeros(len(keys), np.int64)
        n[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(s[first[new]], e[first[new]])]
            encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
            for i in range(0, len(texts), 8192):
                n[new[i:i + 8192]] = [len(x) for x in encode(texts[i:i + 8192], add_special_tokens=False)]
            if len(self.keys) + len(new) > self.most:
                self.keys, self.counts = keys, n
            else:
                order = np.argsort(merged := np.concatenate([self.keys, keys[new]]), kind="stable")
                self.keys, self.counts = merged[order], np.concatenate([self.counts, n[new]])[order]
        sums = np.concatenate([[0], np.cumsum(n[back])])
        where = np.searchsorted(s, off)
        return sums[where[1:]] - sums[where[:-1]]


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = TOKENIZER,
                 limit: int = LIMIT, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row a row: ``doc_id, n_bytes, n_tokens, over_limit, chunked``.

    ``name`` is a vocabulary file of the public tokenizers or a path. Null text
    is empty and has 0 tokens. Special strings in texts count as the library
    counts them by default. An empty table gives no rows.
    """
    d = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok = tokenizer(name)
        counter = PieceCounter(tok)
        for whole in batches:
            for b in pieces(whole, 1):
                data, off = buffers(b.column(1))
                size = np.diff(off)
                long = size > long_bytes
                n = np.zeros(len(size), np.int64)
                if long.any():
                    for i in np.flatnonzero(long):
                        n[i] = count_chunked(tok, b.column(1)[int(i)].as_py())
                    short = b.column(1).filter(pa.array(~long))
                    n[~long] = counter.count(*buffers(short))
                else:
                    n = counter.count(data, off)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(n), pa.array(n > limit),
                                                  pa.array(long)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit", "chunked"])

    return ship(d).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, chunked boolean")
