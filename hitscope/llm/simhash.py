"""Near-duplicates by SimHash fingerprints, pigeonhole blocks and exact Hamming distances.

The 64 bits of a fingerprint are cut into 6 blocks. Of two fingerprints that differ in
at most 3 bits at least 3 blocks agree, so each of them is filed under the 20
choices of 3 blocks (some 32 bits), and close ones meet in a bucket. A bucket links its members
to its smallest one where the distance allows. Buckets whose members are still
in different components after that are mostly a few fingerprints, which are compared pair by
pair; the larger ones are filed again, by parts of the bits that their members
do not share as yet: a close pair agrees in one of four parts as well. So every link
is found, no bucket that is compared pairwise is large, and nothing is emitted for
pairs that are in one component already.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hitscope.llm.common import row_slices, save, utf8
from hitscope.llm.dart_minhash import components

#: Bits in which linked fingerprints may differ, and words of a shingle.
DISTANCE, WIDTH = 3, 3
#: Blocks of a fingerprint, and how many of them a bucket agrees in: all but DISTANCE.
BLOCKS, AGREED = 6, 3
#: Parts that the other bits of a large bucket are cut into: more than DISTANCE, so that a close pair agrees in one.
PARTS = 4
#: Members of a bucket that is compared pair by pair.
SMALL = 32
SEED = 42
#: Bytes of a text that are in work at once.
PIECE = 1 << 20

# The bytes that separate words.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all rows in lower case, one blank behind each; where they start and end, and the words up to each row's end."""
    blank = _BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True  # an empty row's start is that of the next one
    first = first[:-1]
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | first))
    behind = np.ones(len(data), bool)
    behind[:-1] = blank[1:] | first[1:]
    ends = np.flatnonzero(~blank & behind) + 1
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - (lengths + 1)
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    solid = ~blank
    shift = np.repeat(to - starts, lengths)
    out[np.flatnonzero(solid) + shift] = _LOWER[data[solid]]
    return out.tobytes(), to, to + lengths, np.searchsorted(starts, offsets[1:])


def _counts(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(rows, 64): how many hashes of each row have a bit; *ends* are the hashes up to each row's end."""
    total = np.zeros((len(ends), 64), np.int64)
    row = np.searchsorted(ends, np.arange(len(hashes)), "right")
    for at in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = row[at : at + (1 << 16)]
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        total[own[begins]] += np.add.reduceat(part, begins, axis=0, dtype=np.int32)
    return total


def _shingles(data: np.ndarray, offsets: np.ndarray, short_too: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit counts and number of shingles of each row, and its number of words."""
    text, starts, ends, upto = _words(data, offsets)
    words = np.diff(upto, prepend=0)
    count = np.maximum(words - (WIDTH - 1), (words > 0) & short_too)
    # The first words of a row's shingles, and how many words each has.
    row = np.repeat(np.arange(len(words)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = (upto - words)[row] + nth
    last = first + np.minimum(words, WIDTH)[row] - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())]
    return _counts(np.array(hashes, np.uint64), np.cumsum(count)), count, words


def _fingerprint(counts: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The bits that more than half of the shingles have."""
    bits = 2 * counts > shingles[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _pieces(data: np.ndarray, size: int):
    """A long text in pieces that end with a word; each begins with the last words of the one before."""
    start = at = 0
    while at < len(data):
        stop = at + size
        while stop < len(data):
            gap = np.flatnonzero(_BLANK[data[stop : stop + size]])
            if len(gap):
                stop += int(gap[0])
                break
            stop += size
        stop = min(stop, len(data))
        yield data[start:stop]
        blank = _BLANK[data[start:stop]]
        begins = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        keep = min(WIDTH - 1, len(begins))
        start = start + int(begins[-keep]) if keep else stop
        at = stop


def row_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = PIECE) -> np.ndarray:
    """Fingerprints of the rows; 0 for a row without words."""
    found = []
    for start, stop in row_slices(offsets, size):
        own = data[offsets[start] : offsets[stop]]
        if len(own) <= size:
            counts, shingles, _ = _shingles(own, offsets[start : stop + 1] - offsets[start])
            found.append(_fingerprint(counts, shingles))
            continue
        total, n, seen = np.zeros((1, 64), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint8)
        for piece in _pieces(own, size):
            counts, shingles, words = _shingles(piece, np.array([0, len(piece)]), short_too=False)
            if not n[0] and words[0] < WIDTH:
                seen = piece
            total, n = total + counts, n + shingles
        if not n[0]:  # only a word or two, and many blanks
            total, n, _ = _shingles(seen, np.array([0, len(seen)]))
        found.append(_fingerprint(total, n))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``, one row for each row of *docs*, with the 64 bits as a BIGINT."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            fp = row_fingerprints(data, offsets)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, fp long")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bits(positions) -> int:
    return sum(1 << p for p in positions)


def first_masks() -> list[int]:
    """Bits of every choice of AGREED blocks."""
    blocks = [_bits(part.tolist()) for part in np.array_split(np.arange(64), BLOCKS)]
    return [sum(chosen) for chosen in combinations(blocks, AGREED)]


def finer_masks(mask: int) -> list[int]:
    """*mask* and one of PARTS parts of the other bits; with fewer other bits than parts all members are close anyway."""
    other = [p for p in range(64) if not mask >> p & 1]
    return [mask | _bits(part.tolist()) for part in np.array_split(np.array(other), PARTS)]


def _filed(frame: DataFrame) -> DataFrame:
    """Distinct fingerprints under each choice of blocks: the choice as ``mask``, the fingerprint's ``bits`` under it."""
    masks = F.array(*[F.lit(_signed(m)) for m in first_masks()])
    return frame.withColumn("mask", F.explode(masks)).withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))


def _filed_finer(large: DataFrame) -> DataFrame:
    """Rows ``fp, label, mask`` of large buckets under the finer masks of their own; buckets with the same bits become one."""

    def run(batches):
        for batch in batches:
            masks, which = np.unique(batch.column("mask").to_numpy(), return_inverse=True)
            finer = np.array([[_signed(f) for f in finer_masks(m & (1 << 64) - 1)] for m in masks.tolist()], np.int64).reshape(-1, PARTS)
            mask = finer[which].ravel()
            fp, label = (np.repeat(batch.column(c).to_numpy(), PARTS) for c in ("fp", "label"))
            yield pa.record_batch([pa.array(x) for x in (fp, label, mask, fp & mask)], ["fp", "label", "mask", "bits"])

    return large.select("fp", "label", "mask").mapInArrow(run, "fp long, label long, mask long, bits long").distinct()


def _mixed(filed: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component, with ``n``, the members of the bucket."""
    sizes = filed.groupBy("mask", "bits").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    return filed.join(sizes.filter("low < high").select("mask", "bits", "n"), ["mask", "bits"])


def hamming_links(distinct: DataFrame, small: int = SMALL) -> DataFrame:
    """``a, b``: links among the distinct ``fp`` whose components are those of all pairs within DISTANCE bits."""
    filed = _filed(distinct.select("fp"))
    hubs = filed.groupBy("mask", "bits").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).filter("a < last").drop("last")
    shared = save(filed.join(hubs, ["mask", "bits"]), "buckets")
    close = distance(F.col("a"), F.col("b")) <= DISTANCE
    star = shared.filter("a < fp").select("a", F.col("fp").alias("b")).filter(close).distinct()
    links = save(star, "links")
    labels = components(links)
    labelled = shared.select("mask", "bits", "fp").join(labels, shared.fp == labels.node, "left")
    mixed = save(_mixed(labelled.select("mask", "bits", "fp", F.coalesce("label", "fp").alias("label"))), "mixed")
    while True:
        few = mixed.filter(F.col("n") <= small)
        side = lambda s: few.select("mask", "bits", F.col("fp").alias(s), F.col("label").alias(f"label_{s}"))
        met = side("a").join(side("b"), ["mask", "bits"]).filter((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & close)
        links = links.union(save(met.select("a", "b").distinct(), "links"))
        large = mixed.filter(F.col("n") > small)
        if large.isEmpty():
            return links
        mixed = save(_mixed(_filed_finer(large)), "mixed")


def near_duplicates(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row for each row of *docs*.

    A fingerprint (16 hexadecimal digits) has the bits that more than half of the hashes of a text's runs
    of three words have, A-Z lowered and repeats counted; a shorter text is one run, and a text
    without words (NULL, empty, blanks) has fingerprint zero, linked like any other. Rows whose
    fingerprints differ in at most 3 bits are linked; ``component_id`` is the smallest ``doc_id`` that
    can be reached. Rows that repeat an id are linked by their own fingerprints each. A row without an
    id has a fingerprint, but links nothing, and its component is NULL. Other columns are not read.
    """
    every = save(fingerprints(docs), "fingerprints")
    named = every.filter("doc_id IS NOT NULL")
    distinct = save(named.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(hamming_links(distinct, small))
    joined = distinct.join(labels, distinct.fp == labels.node, "left")
    labelled = save(joined.select("fp", "first", F.coalesce("label", "fp").alias("label")), "labelled")
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest, "label").select("fp", "component_id")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    found = named.join(classes, "fp").select("doc_id", shown, "component_id")
    unnamed = every.filter("doc_id IS NULL").select("doc_id", shown, F.lit(None).cast("long").alias("component_id"))
    return found.union(unnamed)
