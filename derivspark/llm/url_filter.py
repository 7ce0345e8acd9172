"""URL filter: a bit-parallel wildcard automaton over all rules at once.

Rules are globs over ``host + path``: ``*`` stands for any run of bytes but
``/``, ``**`` for any run. All patterns' positions are packed side by side into
64-bit words; one Shift-And step per byte moves every pattern of every url of a
batch (numpy, one row a url, one column a word).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .textvec import U, buffers

# (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
# Blocked where no rule fits.
BLOCK_GLOBS = ("*casino*/**", "*porn*/**", "*ads-track*/**", "*malware*/**", "**/wp-login.php**", "**.exe")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Automaton:
    """Shift-And masks of many globs. ``accepts`` tells which fit each string."""

    def __init__(self, globs):
        moves, loops, self.last = [], [], []
        first = []
        for glob in globs:
            raw, i, start = glob.encode(), 0, len(moves)
            first.append(start)
            moves.append(None), loops.append(0)
            while i < len(raw):
                if raw[i:i + 2] == b"**":
                    loops[-1], i = 2, i + 2
                elif raw[i:i + 1] == b"*":
                    loops[-1], i = max(loops[-1], 1), i + 1
                else:
                    moves[-1] = raw[i]
                    moves.append(None), loops.append(0)
                    i += 1
            self.last.append(len(moves) - 1)
        self.words = max(1, -(-len(moves) // 64))
        self.move = np.zeros((257, self.words), U)  # symbol 256 pads: every state stays
        self.stay = np.zeros((257, self.words), U)
        self.start = np.zeros(self.words, U)
        for i in first:
            self.start[i // 64] |= U(1 << i % 64)
        for i, (m, loop) in enumerate(zip(moves, loops)):
            bit = U(1 << i % 64)
            if m is not None:
                self.move[m, i // 64] |= bit
            if loop:
                self.stay[:256, i // 64] |= bit
            if loop == 1:
                self.stay[ord("/"), i // 64] &= ~bit
        self.stay[256] = ~U(0)

    def _run(self, symbols: np.ndarray) -> np.ndarray:
        d = np.repeat(self.start[None], len(symbols), 0)
        for c in symbols.T:
            step = d & self.move[c]
            carry = np.zeros_like(step)
            carry[:, 1:] = step[:, :-1] >> U(63)
            d = (step << U(1)) | carry | (d & self.stay[c])
        return np.stack([(d[:, i // 64] >> U(i % 64)) & U(1) for i in self.last], 1).astype(bool)

    def accepts(self, arr: pa.Array, cells: int = 1 << 22) -> np.ndarray:
        """(strings x globs) booleans. Strings are run in order of length, so that a
        batch's matrix stays near ``cells`` bytes whatever the longest is."""
        data, off = buffers(arr)
        n = np.diff(off)
        out = np.zeros((len(n), len(self.last)), bool)
        order, i = np.argsort(n, kind="stable"), 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j - i + 1) * int(n[order[j]]) <= cells:
                j += 1
            rows = order[i:j]
            col = np.arange(int(n[rows[-1]]))
            at = off[:-1][rows][:, None] + col
            inside = col < n[rows][:, None]
            symbols = np.full(at.shape, 256, np.int16)
            symbols[inside] = data[at[inside]]
            out[rows] = self._run(symbols)
            i = j
        return out


def rule_globs(rules) -> list[str]:
    return [g for _, host, path in rules for g in (f"{host}{path}**", f"*.{host}{path}**")]


def canonical(url: str = "url"):
    """(host, path) of a url: host A-Z lower-cased, query and fragment cut; both
    empty for null or where ``://`` is missing."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(F.col(url), F.lit(""))
    return (F.translate(F.regexp_extract(u, pattern, 1), CAPITALS, CAPITALS.lower()), F.regexp_extract(u, pattern, 2))


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
                block_globs=BLOCK_GLOBS) -> DataFrame:
    """One row a row: ``page_id, host, path, rule, verdict``.

    The longest fitting rule decides. Where none fits, a url without host is
    blocked, as is one that fits a block glob; the rest is allowed. Null and
    malformed urls have an empty host and path. Ties between rules of one
    length go to the earlier one. An empty table gives no rows.
    """
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    ranked = [rules[i] for i in order]
    machine = Automaton([*rule_globs(ranked), *block_globs])
    names = [h + p for _, h, p in ranked]
    verdicts = [v for v, _, _ in ranked]

    def judge(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                host, path = part.column(1), part.column(2)
                hit = machine.accepts(pa.compute.binary_join_element_wise(host, path, ""))
                k = len(names)
                rule = hit[:, 0:2 * k:2] | hit[:, 1:2 * k:2]
                found, best = rule.any(1), rule.argmax(1)
                bad = hit[:, 2 * k:].any(1) | (pa.compute.binary_length(host).to_numpy(zero_copy_only=False) == 0)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), host, path,
                    pa.array([names[i] if f else None for f, i in zip(found, best)], pa.string()),
                    pa.array([verdicts[i] if f else ("block" if x else "allow") for f, i, x in zip(found, best, bad)],
                             pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    host, path = canonical(url)
    d = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    kind = d.schema["page_id"].dataType.simpleString()
    return ship(d).mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
