"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\\n text <|im_end|>\\n``; a conversation
is its turns in order. Each rendered turn is parsed again by a deterministic
parser and compared with its source. A turn that does not come back identical,
or that holds a control string of any known template, is rendered again with
its content escaped, until the parse gives the source.

Escaping puts one backslash after the first character of a control string and
one more into strings that already look escaped; unescaping takes one away.
It is a bijection, and an escaped text contains no control string.

The grammar is a plain repetition of turns with an unambiguous end, so the
round trip of every turn implies that of the conversation, and a conversation
is streamed turn by turn: memory holds one turn, however long it is.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates: fixed values.
CONTROLS = (START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]",
            "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
_RAW = re.compile("|".join(map(re.escape, CONTROLS)))
_PLAIN = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROLS))
_TURN = re.compile(f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """(role, text as written) of each turn; None if the string is not in the grammar."""
    at, out = 0, []
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if not m:
            return None
        out.append((m[1], m[2]))
        at = m.end()
    return out


def render(role: str, text: str) -> tuple[str, str, bool]:
    """(rendered turn, its text as written, escaped?) such that parsing it gives the source."""
    safe_role = role.replace("\\", "\\\\").replace("\n", "\\n")
    for escaped in (False, True):
        head = escape(safe_role) if escaped else safe_role
        body = escape(text) if escaped else text
        out = f"{START}{head}\n{body}{END}\n"
        if parse(out) != [(head, body)] or (not escaped and _RAW.search(safe_role + "\n" + text)):
            continue
        back = unescape(body) if escaped or _PLAIN.search(body) else body
        if back == text and (unescape(head) == safe_role):
            return out, body, escaped
    raise ValueError("turn does not survive the round trip")


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row a turn, in order within its conversation: ``conv_id, position,
    role, rendered`` (the turn as formatted), ``loss_start, loss_end`` (code
    points of the turn under the loss mask; equal where none), ``escaped``.

    Null text and null roles are empty. Turns of equal number are ordered by
    role, then text; repeated rows stay. A null conversation id is a
    conversation of its own. An empty table gives no rows.
    """
    d = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                    F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = d.schema["conv_id"].dataType.simpleString()

    def run(batches):
        last, position = object(), 0
        for b in batches:
            out = []
            for cid, r, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                position = position + 1 if cid == last else 0
                last = cid
                whole, body, escaped = render(r, t)
                start = len(whole) - len(END) - 1 - len(body)
                out.append((cid, position, r, whole, start, start + len(body) if r == loss_role else start, escaped))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), [b.column(0).type, pa.int64(), pa.string(), pa.string(),
                                                              pa.int64(), pa.int64(), pa.bool_()])],
                ["conv_id", "position", "role", "rendered", "loss_start", "loss_end", "escaped"]) if out else b.slice(0, 0)

    return ship(d).mapInArrow(_nonempty(run), f"conv_id {kind}, position long, role string, rendered string, "
                                        "loss_start long, loss_end long, escaped boolean")


def _nonempty(run):
    return lambda batches: run(b for b in batches if b.num_rows)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read back from the rendered turns: they
    are parsed again, text and role unescaped, and hashed in order."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        cid, state = None, None

        def row():
            n, turn_hash, chars, loss, length, escaped = state
            return cid, n, turn_hash.hexdigest(), chars, loss.hexdigest(), length, escaped

        for b in batches:
            out = []
            for c, whole, lo, hi, esc in zip(*(b.column(i).to_pylist() for i in (0, 3, 4, 5, 6))):
                if state is None or c != cid:
                    if state is not None:
                        out.append(row())
                    cid, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                (head, body), = parse(whole)
                text, name = unescape(body), re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))
                state[0] += 1
                state[1].update(f"{name}\n{text}\n".encode())
                loss = unescape(whole[lo:hi])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(whole)
                state[5] += esc
            if out:
                yield _digest_batch(out, b.column(0).type)
        if state is not None:
            yield _digest_batch([row()], b.column(0).type)

    return ship(turns).mapInArrow(_nonempty(run), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                            "loss_sha256 string, formatted_chars long, escaped_turns long")


def _digest_batch(rows, kind):
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "escaped_turns"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)
