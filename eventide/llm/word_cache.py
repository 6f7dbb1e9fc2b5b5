"""Ids of white-space chunks, remembered by a worker process across the tasks that it runs.

Not pickled with the tasks (see ``base.by_value``): the dictionary must outlive one task.
"""

from __future__ import annotations

import os

MOST = 1_100_000  # chunks remembered, about 230 MB, before the worker starts afresh
MARK = "\x01"
GROUP = 512

_OPEN: dict[str, tuple] = {}


def opened(path: str) -> tuple:
    """(tokenizer, id of the mark between chunks, chunk -> little-endian ids) for a tokenizer file."""
    if path not in _OPEN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        mark = tok.encode(MARK, add_special_tokens=False).ids
        _OPEN[path] = (tok, mark[0] if len(mark) == 1 else None, {"": b""})
    return _OPEN[path]


def learn(path: str, chunks: set[str]) -> dict[str, bytes]:
    """The dictionary, now with all of ``chunks``.

    Chunks are encoded many at a time, with the mark as a word of its own between
    them: no tokenizer rule reaches across the spaces around it.  Chunks that hold the mark are encoded alone."""
    import numpy as np

    tok, mark, known = opened(path)
    new = [w for w in chunks if w not in known]
    if len(known) + len(new) > MOST:
        known.clear()
        known[""] = b""
        new = [w for w in chunks if w]
    alone = [w for w in new if mark is None or MARK in w]
    for w, e in zip(alone, tok.encode_batch_fast(alone, add_special_tokens=False)):
        known[w] = np.array(e.ids, "<u4").tobytes()
    if alone:
        odd = set(alone)
        new = [w for w in new if w not in odd]
    groups = [new[i:i + GROUP] for i in range(0, len(new), GROUP)]
    for words, e in zip(groups, tok.encode_batch_fast([f" {MARK} ".join(g) for g in groups], add_special_tokens=False)):
        ids = np.array(e.ids, "<u4")
        ends = (4 * np.flatnonzero(ids == mark)).tolist() + [4 * len(ids)]
        if len(ends) != len(words):
            raise ValueError("the mark did not stay a word of its own")
        data, at = ids.tobytes(), 0
        for w, end in zip(words, ends):
            known[w] = data[at:end]
            at = end + 4
    return known
