"""Quality rules, line first.

Every line of a text is judged by itself; lines that fail are removed, and a
document that loses too much of its text that way is rejected, as is one that
fails the base rule on the whole text.

Line rules (only lines with a word are judged):
* punctuation - symbols ``[#*$%&|<>]`` and doubled ``!!`` make up more than
  ``max_symbols`` percent of the line's word characters;
* navigation - three or more parts between ``|``, ``»``, ``›`` or ``>``
  surrounded by spaces;
* boilerplate - the line holds one of ``BOILERPLATE``, or repeats an earlier
  line of the document.

Defined results: a null or wordless text has no words, so it fails the base
rule (fewer than ten words). Null ids and repeated rows are judged like any
other row. An empty table gives an empty result; other columns of the input
are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.common import SPACE, inside, narrow, pieces, rolling, small_batches, text_buffer, utf8_points, words

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MIN_WORDS = 10
MAX_REPEAT = 20          # percent of the words in repeated 5-word windows
WINDOW = 5
MAX_SYMBOLS = 10         # percent of a line's word characters
MAX_LOST = 50            # percent of a text's word characters
# ---- fixed values: phrases that mark a line as boilerplate (lower case)
BOILERPLATE = ["accept all cookies", "we use cookies", "cookie policy", "enable javascript", "javascript is disabled",
               "privacy policy", "terms of use", "terms of service", "subscribe to our newsletter", "sign up for our",
               "click here to", "skip to content", "back to top", "share on facebook", "lorem ipsum"]
_BOILER = re.compile("|".join(map(re.escape, BOILERPLATE)))
_NAV = re.compile(r"(?: [|»›>] .*){2}")
_STRIP = " \t\x0b\x0c\r"

_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_lines long, n_lines_removed long, removed_chars long, base_failed boolean, kept boolean{text}")
_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
           ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_lines", pa.int64()),
           ("n_lines_removed", pa.int64()), ("removed_chars", pa.int64()), ("base_failed", pa.bool_()),
           ("kept", pa.bool_())]


def line_fails(line: str, chars: int, max_symbols: int = MAX_SYMBOLS) -> bool:
    """Punctuation, navigation and phrase rules for one line of ``chars``
    word characters (repeats are found by the caller, who knows the text)."""
    bad = sum(map(line.count, "#*$%&|<>")) + 2 * line.count("!!")
    if bad and 100 * bad > max_symbols * chars:
        return True
    if ("|" in line or "»" in line or "›" in line or ">" in line) and _NAV.search(line):
        return True
    return _BOILER.search(line.lower()) is not None


def clean_lines(text: str, max_symbols: int = MAX_SYMBOLS) -> tuple[list[str], int, int, int, int]:
    """Lines that stay, then counts: lines with a word, lines removed, word
    characters removed, repeated lines."""
    stay, seen = [], set()
    n_lines = removed = chars_removed = dup = 0
    for line in text.split("\n"):
        bare = line.translate(_NO_SPACE)
        if not bare:
            stay.append(line)
            continue
        n_lines += 1
        again = line in seen
        dup += again
        seen.add(line)
        if again or line_fails(line, len(bare), max_symbols):
            removed += 1
            chars_removed += len(bare)
        else:
            stay.append(line)
    return stay, n_lines, removed, chars_removed, dup


_NO_SPACE = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def repeated_words(h: np.ndarray, off: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of ``width`` words found at
    least twice in that text."""
    n_docs = len(off) - 1
    total = int(off[-1])
    roll, ok = rolling(h, width), inside(off, width)
    pos = np.flatnonzero(ok)
    if not len(pos):
        return np.zeros(n_docs, dtype=np.int64)
    doc = np.searchsorted(off, pos, side="right") - 1
    key = roll[pos]
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(k), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = pos[order[twice]]
    cover = np.zeros(total + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    return covered[off[1:]] - covered[off[:-1]]


def _judge(min_words, max_repeat, max_symbols, max_lost, with_text):
    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            ids = batch.column(0)
            for lo, hi in pieces(off):
                o = off[lo:hi + 1]
                w = words(data, o)
                n_words = np.diff(w.off)
                repeats = repeated_words(w.hash, w.off)
                rows = []
                for i in range(hi - lo):
                    raw = data[o[i]:o[i + 1]]
                    chars = utf8_points(raw) - int(np.count_nonzero(SPACE[raw]))
                    symbols = int(np.count_nonzero(SYMBOLS[raw]))
                    stay, lines, gone, lost, dup = clean_lines(raw.tobytes().decode("utf-8", "replace"), max_symbols)
                    failed = bool(n_words[i] < min_words or 100 * repeats[i] > max_repeat * n_words[i])
                    kept = not failed and 100 * lost <= max_lost * chars
                    rows.append((int(n_words[i]), chars, symbols, dup, int(repeats[i]), lines, gone, lost, failed, kept)
                                + (("\n".join(stay),) if with_text else ()))
                fields = _FIELDS + ([("clean_text", pa.string())] if with_text else [])
                cols = [ids.slice(lo, hi - lo)] + [pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields[1:])]
                yield pa.RecordBatch.from_arrays(cols, names=[n for n, _ in fields])
    return run


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  max_repeat: int = MAX_REPEAT, max_symbols: int = MAX_SYMBOLS, max_lost: int = MAX_LOST,
                  with_text: bool = False) -> DataFrame:
    """One row per document with its counts and verdict; ``with_text`` adds
    ``clean_text``, the text without the lines that failed."""
    return narrow(docs, id_col, text_col).mapInArrow(
        _judge(min_words, max_repeat, max_symbols, max_lost, with_text),
        _SCHEMA.format(text=", clean_text string" if with_text else ""))


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The documents that pass, all their columns, with failed lines removed
    from the text. Rows are judged where they are: no shuffle."""
    small_batches(docs.sparkSession)
    cols = docs.columns
    judge = _judge(rules.get("min_words", MIN_WORDS), rules.get("max_repeat", MAX_REPEAT),
                   rules.get("max_symbols", MAX_SYMBOLS), rules.get("max_lost", MAX_LOST), True)
    at, kind = cols.index(text_col), docs.schema[text_col].dataType

    def run(batches):
        zero = pa.int64()
        for batch in batches:
            judged = pa.Table.from_batches(judge([pa.RecordBatch.from_arrays(
                [pa.nulls(len(batch), zero), batch.column(at)], names=["doc_id", "text"])]))
            if not judged.num_rows:
                continue
            keep = judged["kept"].combine_chunks()
            text = judged["clean_text"].combine_chunks().cast(batch.schema.field(at).type)
            arrays = [text if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema).filter(keep)

    assert kind.simpleString() == "string"
    return docs.mapInArrow(run, docs.schema)
