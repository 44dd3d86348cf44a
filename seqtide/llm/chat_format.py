"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, turn by turn:

    <|im_start|>role<|im_sep|>text<|im_end|>\\n

and encoded once, with the offsets of every token. The three marks are tokens of
their own, so a text begins and ends at a token. The texts that are to be learned
are spans of the rendering; a binary search in the sorted token offsets finds the
tokens that intersect each span.

Inside roles and texts a backslash goes between ``<`` and ``|`` (and one more where
backslashes already stand there), so nothing in them can look like a mark; taking
it out again is exact.

Turns are ordered by (turn, role, text), nulls first; repeated turns are kept. A null
role or text counts as empty. Rows without a conv_id form one conversation with a
null id. An assistant turn without text adds nothing to the mask. Other columns are
not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtide.llm.texts import byte_letters, id_bytes

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Characters of rendered conversations that are encoded at a time.
BATCH_CHARS = 1 << 20

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The rendering of (role, text) turns and the span of each text to learn, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body, tail = START + escape(role) + SEP, escape(text), END + "\n"
        at += len(head)
        if role == learn and body:
            spans.append((at, at + len(body)))
        at += len(body) + len(tail)
        parts += (head, body, tail)
    return "".join(parts), spans


def token_spans(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """First and last-plus-one token that intersects each span; both inputs are sorted."""
    if not spans:
        return np.zeros((0, 2), np.int64)
    want = np.array(spans, np.int64)
    first = np.searchsorted(offsets[:, 1], want[:, 0], "right")
    last = np.searchsorted(offsets[:, 0], want[:, 1], "left")
    return np.stack([first, last], axis=1)


class ChatCodec:
    """A byte-level vocabulary with the three marks added."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        marks = (START, SEP, END)
        self.tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in marks])
        self.start, self.sep, self.end = map(self.tokenizer.token_to_id, marks)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.bytes = {i: bytes(map(byte_of.__getitem__, t))
                      for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                      if all(c in byte_of for c in t)}
        self.bytes.update((i, t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items())

    def text(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()

    def turns(self, ids: list[int]) -> list[tuple[str, str]]:
        """The (role, text) turns of an encoded conversation."""
        out, begun = [], None
        for at, i in enumerate(ids):
            if i == self.start:
                begun, role = at, None
            elif i == self.sep:
                role, begun = unescape(self.text(ids[begun + 1:at])), at
            elif i == self.end:
                out.append((role, unescape(self.text(ids[begun + 1:at]))))
        return out


@lru_cache(maxsize=2)
def chat_codec(path: str) -> ChatCodec:
    """One codec for a Python worker."""
    return ChatCodec(path)


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def format_conversations(rows: DataFrame, vocabulary: str, learn: str = "assistant") -> DataFrame:
    """conv_id, ids (little-endian unsigned 32-bit), loss (token ranges to learn) per conversation."""
    whole = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = chat_codec(vocabulary)

        def encoded(keys: list, rendered: list[tuple[str, list[tuple[int, int]]]]) -> pa.RecordBatch:
            ids, loss = [], []
            for e, (_, spans) in zip(codec.tokenizer.encode_batch([r[0] for r in rendered], add_special_tokens=False),
                                     rendered, strict=True):
                ids.append(id_bytes(e.ids))
                found = token_spans(np.array(e.offsets, np.int64).reshape(-1, 2), spans).tolist()
                loss.append([{"first": a, "last": b} for a, b in found])
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(loss, _SPANS)],
                                              names=["conv_id", "ids", "loss"])
        for batch in batches:
            keys, rendered, size = [], [], 0
            for i in range(batch.num_rows):
                turns = batch.column("turns")[i].as_py()
                keys.append(batch.column("conv_id")[i].as_py())
                rendered.append(render([(t["role"] or "", t["text"] or "") for t in turns], learn))
                size += len(rendered[-1][0])
                if size >= BATCH_CHARS:
                    yield encoded(keys, rendered)
                    keys, rendered, size = [], [], 0
            if keys:
                yield encoded(keys, rendered)
    return whole.mapInArrow(run, "conv_id long, ids binary, loss array<struct<first: long, last: long>>")


def read_back(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """What the encoded conversations hold: turns, text under the mask and sizes, as digests."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = chat_codec(vocabulary)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<u4").tolist()
                spans = [(s["first"], s["last"]) for s in batch.column("loss")[i].as_py()]
                turns = codec.turns(ids)
                learned = "".join(unescape(codec.text(ids[a:b])) for a, b in spans)
                said = hashlib.sha256()
                for role, text in turns:
                    said.update(f"{role}\n{text}\n".encode())
                out.append((batch.column("conv_id")[i].as_py(), len(turns), said.hexdigest(), len(learned),
                            hashlib.sha256(learned.encode()).hexdigest(), len(codec.text(ids)), len(ids),
                            sum(b - a for a, b in spans)))
            kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * len(names), kinds, strict=True)], names=names)
    schema = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names)
    return formatted.mapInArrow(run, schema)
