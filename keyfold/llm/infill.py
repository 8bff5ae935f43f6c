"""Fill-in-the-middle: texts cut into prefix, middle and suffix at units, by arithmetic on whole words.

The bytes of many texts are viewed as 64-bit words. Letters, and bytes that continue a
character, are marked in all eight bytes of a word at once by additions that never
carry from byte to byte; from these follow the bytes that end a unit. A count of bits
per word, summed up, tells the word of any unit's end by binary search, and a
multiplication finds the byte in it. No text is split into units.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm import words

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts of 100 that are cut, and cut ones of 100 whose suffix goes first.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20


def _every(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW, _ONES = _every(0x80), _every(0x7F), _every(0x01)


class Marks:
    """Marked bytes of a line of texts: how many lie before a byte, and where the n-th is."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in bytes below ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.bits[word] & below)

    def select(self, n: np.ndarray) -> np.ndarray:
        """The byte of the n-th mark, counted from 1."""
        word = np.searchsorted(self.before, n, side="left") - 1
        # In each byte the marks up to it: eight at most, so sums stay inside a byte.
        upto = ((self.bits[word] >> np.uint64(7)) & _ONES) * _ONES
        wanted = (n - self.before[word]).astype(np.uint64) * _ONES
        reached = np.bitwise_count(((upto | _HIGH) - wanted) & _HIGH)
        return word * 8 + 8 - reached


def marks(data: np.ndarray, bounds: np.ndarray) -> tuple[Marks, Marks]:
    """Ends of units and starts of characters of consecutive texts.

    A unit is a run of ASCII letters, or any other character.
    """
    padded = np.zeros((len(data) // 8 + 1) * 8, dtype=np.uint8)
    padded[:len(data)] = data
    line = padded.view("<u8")
    folded = (line | _every(0x20)) & _LOW
    letter = (folded + _every(0x80 - 0x61)) & ~(folded + _every(0x80 - 0x7B)) & ~line & _HIGH
    continues = line & ~(line << np.uint64(1)) & _HIGH
    after_letter = letter << np.uint64(8)
    after_letter[1:] |= letter[:-1] >> np.uint64(56)
    starts = ~continues & ~(letter & after_letter) & _HIGH
    starts.view(np.uint8)[bounds] |= 0x80  # no unit goes over the end of a text
    ends = starts >> np.uint64(8)
    ends[:-1] |= starts[1:] << np.uint64(56)
    ends.view(np.uint8)[len(data):] = 0
    return Marks(ends), Marks(~continues & _HIGH)


def cuts(data: np.ndarray, bounds: np.ndarray, one: np.ndarray, two: np.ndarray):
    """Units of each text; byte offsets and characters of the two cuts, at draws modulo the number of places."""
    ends, chars = marks(data, bounds)
    before = ends.rank(bounds)
    n = np.diff(before)
    one, two = one % (n + 1), two % (n + 1)
    first, at = bounds[:-1], []
    for k in (np.minimum(one, two), np.maximum(one, two)):
        at.append(np.where(k > 0, ends.select(np.maximum(before[:-1] + k, 1)) + 1, first))
    start, mid, end = chars.rank(first), chars.rank(at[0]), chars.rank(at[1])
    return n, at[0], at[1], mid - start, end - mid


def draws(doc_id: Column) -> Column:
    """The first four 32-bit groups of the sha256 of ``1:`` and the id; without an id, of ``1:`` alone."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


_OWN = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns n, form, prefix_chars, middle_chars and output beside those of ``docs``.

    ``form`` is ``plain`` (the text as it is: it is empty, holds a marker, or is one of the
    tenth left whole), ``psm`` or ``spm`` (prefix or suffix first). A null text is an empty one.
    What happens to a text depends on its id and itself alone, so repeated rows come out
    alike. Columns of ``docs`` with the five names are replaced; an empty table stays empty.
    """
    docs = docs.drop(*_OWN)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, k) for c, k in _OWN.items())])
    tags = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        for batch in batches:
            drawn, column = batch.schema.get_field_index("_draws"), batch.schema.get_field_index(text)
            for at, to, data, bounds in words.chunks(batch.column(column)):
                part = batch.slice(at, to - at)
                h = part.column(drawn).flatten().to_numpy().reshape(-1, 4)
                n, left, right, prefix, middle = cuts(data, bounds, h[:, 0], h[:, 1])
                marked = pc.fill_null(pc.match_substring_regex(part.column(column), "<[PSM]>"), False).to_numpy(zero_copy_only=False)
                plain = (np.diff(bounds) == 0) | marked | (h[:, 2] % 100 >= CUT_SHARE)
                suffix_first = h[:, 3] % 100 < SUFFIX_FIRST_SHARE
                body, out = data.tobytes(), []
                for i in range(to - at):
                    a, b, c, d = bounds[i], left[i], right[i], bounds[i + 1]
                    if plain[i]:
                        out.append(body[a:d])
                    elif suffix_first[i]:
                        out.append(b"".join((tags[1], body[c:d], tags[0], body[a:b], tags[2], body[b:c])))
                    else:
                        out.append(b"".join((tags[0], body[a:b], tags[1], body[c:d], tags[2], body[b:c])))
                form = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [*(c for i, c in enumerate(part.columns) if i != drawn), pa.array(n), pa.array(form.tolist(), pa.string()),
                     pa.array(prefix, mask=plain), pa.array(middle, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                    names=schema.names)

    return docs.withColumn("_draws", draws(F.col(doc_id))).mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from. A marker inside a cut text cannot be: such texts stay plain."""
    body = F.substr(F.col(output), F.lit(len(PREFIX) + 1))

    def halves(whole: Column, tag: str) -> tuple[Column, Column]:
        head = F.substring_index(whole, tag, 1)
        return head, F.substr(whole, F.length(head) + len(tag) + 1)

    prefix, rest = halves(body, SUFFIX)
    suffix, middle = halves(rest, MIDDLE)
    suffix_first, after = halves(body, PREFIX)
    prefix_second, middle_last = halves(after, MIDDLE)
    return (F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
            .when(F.col(form) == "spm", F.concat(prefix_second, middle_last, suffix_first)).otherwise(F.col(output)))
