"""Token counts: batch encoding inside Arrow functions that return lengths only.

A text is cut at boundaries no token can cross, equal pieces are encoded once as long as a
process remembers them, and the pieces still unknown go to the library in batches of bounded bytes. So one very long text costs no
more memory than many short ones, and only integers leave the workers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import bounded_batches, free_name

BATCH_BYTES = 1 << 16   # bytes of text handed to the library at once
MEMO_TOTAL = 24 << 20   # bytes of each of a process's two memories; beyond it the memory starts anew
ENTRY = 120             # bytes of a remembered piece beside its own
MEMO_BYTES = 48         # longer pieces are encoded but not remembered
SLICE_WORDS = 200_000   # words of one text held as objects at a time


def piece_counter(tokenizer_path: str):
    """A function from texts (bytes, UTF-8) to exact token counts of the ``tokenizers`` file.

    Safe boundaries: the file's splitter drops white space, so no token crosses ASCII white space.
    Within a word of ASCII letters, digits and signs its pattern also splits the same way wherever
    the word stands, and it lower-cases, so such words count as the sum of their pattern pieces.
    Every other word, and every text that may hold a special token's string (``<|``), goes to the
    library whole, so composition, case and special strings are its own."""
    import os
    import re

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads only add memory
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    tok.no_truncation()
    tok.no_padding()
    # fixed value: the split pattern of the vocabulary file, narrowed to ASCII
    pattern = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
    words: dict[bytes, int] = {}
    pieces: dict[bytes, int] = {}
    held = {"words": 0, "pieces": 0}  # their bytes

    def encode(new: list[bytes], memo: dict[bytes, int]) -> None:
        """Put the counts of ``new`` into ``memo``, in batches balanced by bytes."""
        batch: list[str] = []
        size = 0
        at = 0
        for i, piece in enumerate(new):
            batch.append(piece.decode("utf-8"))
            size += len(piece)
            if size >= BATCH_BYTES or i + 1 == len(new):
                for enc in tok.encode_batch_fast(batch, add_special_tokens=False):
                    memo[new[at]] = len(enc)
                    at += 1
                batch, size = [], 0

    def split(word: bytes) -> list[bytes]:
        return pattern.findall(word.lower()) if word.isascii() and b"<|" not in word else [word]

    def learn(new: list[bytes]) -> None:
        """Counts of new words, from the counts of their pieces."""
        for name, memo in (("words", words), ("pieces", pieces)):
            if held[name] > MEMO_TOTAL:
                memo.clear()
                held[name] = 0
        parts = [split(w) for w in new]
        unknown = list({p for ps in parts for p in ps}.difference(pieces))
        encode(unknown, pieces)
        for name, added in (("words", new), ("pieces", unknown)):
            held[name] += sum(ENTRY + len(x) for x in added if len(x) <= MEMO_BYTES)
        for w, ps in zip(new, parts):
            words[w] = sum(map(pieces.__getitem__, ps))
        for long in [p for ps in parts for p in ps if len(p) > MEMO_BYTES]:
            pieces.pop(long, None)

    def slices(raw: bytes) -> Iterator[list[bytes]]:
        """The words of a text, a bounded number at a time."""
        step = SLICE_WORDS * 8
        if len(raw) <= 2 * step:
            yield raw.split()
            return
        at = 0
        while at < len(raw):
            end = at + step
            while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
                end += 1
            yield raw[at:end].split()
            at = end

    def count(texts: list[bytes]) -> list[int]:
        # one set of unknown words per batch of texts: the library sees large batches
        out = [0] * len(texts)
        pending: list[tuple[int, list[bytes]]] = []
        waiting = 0

        def settle() -> None:
            nonlocal waiting
            fresh = list({w for _, ws in pending for w in ws}.difference(words))
            if fresh:
                before = len(words)
                learn(fresh)
                if before > len(words):  # the memory started anew: known words went with it
                    rest = list({w for _, ws in pending for w in ws}.difference(words))
                    if rest:
                        learn(rest)
            for at, ws in pending:
                out[at] += sum(map(words.__getitem__, ws))
            for w in fresh:
                if len(w) > MEMO_BYTES:
                    words.pop(w, None)
            pending.clear()
            waiting = 0

        for at, raw in enumerate(texts):
            # lower-casing ASCII first merges pieces; not where it could make a special string
            for ws in slices(raw if b"<|" in raw else raw.lower()):
                pending.append((at, ws))
                waiting += len(ws)
                if waiting >= SLICE_WORDS:
                    settle()
        settle()
        return out

    return count


def process_counter(tokenizer_path: str):
    """The process's counter of a vocabulary. Workers live on between tasks, and every further tokenizer
    a process loads costs memory that does not come back, so it keeps one, in a module of its own name
    (this one travels by value and is new in every task)."""
    import sys
    import types

    kept = sys.modules.setdefault("cairn_worker_counters", types.ModuleType("cairn_worker_counters")).__dict__
    if kept.get("path") != tokenizer_path:
        kept.update(path=tokenizer_path, counter=piece_counter(tokenizer_path))
    return kept["counter"]


def token_lengths(tokenizer_path: str):
    """An Arrow function: text column -> token counts (null counts as the empty text)."""

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = process_counter(tokenizer_path)
        for texts in batches:
            raw = texts.cast(pa.binary())
            yield pa.array(count([x or b"" for x in raw.to_pylist()]), pa.int64())

    return lengths


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = 2048,
                 n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit") -> DataFrame:
    """``docs`` with the UTF-8 bytes, tokens and an over-the-limit mark of every whole text.

    ``tokenizer_path``: a file of the ``tokenizers`` library whose splitter drops white space and
    which lower-cases (the word-level vocabulary); no begin, end or added special tokens, no
    truncation. A null or empty text has 0 bytes and 0 tokens; equal rows stay equal rows; other
    columns pass unchanged, and output names that clash with them get a leading underscore.
    Only the text column goes to Python, no shuffle."""
    bounded_batches(docs.sparkSession)
    b, t, o = free_name(docs, n_bytes, n_tokens, over_limit)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.withColumn(b, F.octet_length(text).cast("long"))
            .withColumn(t, token_lengths(tokenizer_path)(text))
            .withColumn(o, F.col(t) > limit))
