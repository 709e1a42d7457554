"""Near duplicates by DartMinHash signatures, banded joins and an exact check of the candidates."""

from __future__ import annotations

import string
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, col, held, id_and_text, map_texts, stored, with_ids, without_ids
from .components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5  # a pair at the threshold shares a band with probability 1 - (1 - 0.8**5)**32 > 0.99999
ELEMENTS_AT_ONCE, SETS_AT_ONCE = 200_000, 500
TEXTS_AT_ONCE = 1_000  # of an Arrow batch, whose words and shingles a Python worker holds together
CACHED_WORDS, CACHED_LENGTH = 300_000, 64
PARITY = 4  # words of 64 bits; a power of two

_SPACED = str.maketrans({c: " " for c in string.punctuation})
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose results look random."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64 random bits."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


# --- signatures ---------------------------------------------------------------------------------


def dart_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """``n x k`` signatures of weighted sets given as elements with their weight and their set.

    Darts are thrown at the plane of weight and rank. What lands in an element's unit region
    ``[c, c + 1)`` of weight is a Poisson process in rank that depends on element and region
    alone, so sets that share weight share darts. A set sees the darts below its weights. Each dart has a coordinate, and
    the one of least rank is the signature's value there: equal for two sets with the
    probability of their weighted Jaccard similarity. Only darts up to rank ``theta`` are thrown, some ``k ln k + 2 k`` a set
    whatever its size; a set with an empty coordinate throws up to twice that rank again.
    Every set must have an element of positive weight.
    """
    regions = np.ceil(weights).astype(np.int64)
    of = np.repeat(np.arange(len(elements)), regions)
    copy = np.arange(len(of)) - np.repeat(np.cumsum(regions) - regions, regions)
    key = mix(elements[of] ^ mix(copy.astype(np.uint64) + _U(0x9E3779B97F4A7C15)))
    inside = np.minimum(1.0, weights[of] - copy)
    whose = owner[of]
    theta = k * (np.log(k) + 2) / np.maximum(np.bincount(owner, weights, n), 1e-300)
    signature = np.zeros((n, k), np.uint64)
    todo = np.ones(n, bool)
    while todo.any():
        chosen = todo[whose]
        live, who, top = key[chosen], whose[chosen], inside[chosen]
        limit = theta[who]
        rank = np.zeros(len(live))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        thrown = 0
        while len(live):
            many = 1 if len(live) > 4096 else 16  # several darts a region at once when few regions are left
            number = np.arange(thrown + 1, thrown + many + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)
            dart = mix(live[:, None] + number[None, :])
            ranks = rank[:, None] + np.cumsum(-np.log(_uniform(dart)), axis=1)
            hits = ranks < limit[:, None]
            place = mix(dart ^ _U(0xA0761D6478BD642F))
            seen = hits & (_uniform(mix(place)) <= top[:, None])
            found.append((np.broadcast_to(who[:, None], seen.shape)[seen], place[seen], ranks[seen]))
            more = hits[:, -1]
            live, who, top, limit, rank = live[more], who[more], top[more], limit[more], ranks[more, -1]
            thrown += many
        sets, darts, ranks = (np.concatenate(x) for x in zip(*found))
        slot = sets * k + (darts % _U(k)).astype(np.int64)
        order = np.argsort(-ranks, kind="stable")
        filled = np.zeros(n * k, bool)
        values = signature.reshape(-1)
        values[slot[order]] = darts[order] | _U(1)  # the last one written has the least rank
        filled[slot] = True
        todo &= ~filled.reshape(n, k).all(axis=1)
        theta[todo] *= 2
    return signature


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = h
        return h


def words_of(text: str) -> list[str]:
    return text.lower().translate(_SPACED).split()


def shingles(words: list[str], width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words, sorted; a shorter text is one run."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = held("words", None, _WordHashes)
    h = np.array([hashes[w] for w in words], np.uint64)
    n = max(1, len(words) - width + 1)
    out = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(width, len(words))):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[k : k + n])
    out.sort()
    return out


def elements_of(words: list[str], width: int = SHINGLE) -> np.ndarray:
    """A text's shingles as a set: the second copy of a shingle is an element of its own, and so on.

    The Jaccard similarity of such sets is the weighted one of shingles with their counts.
    """
    h = shingles(words, width)
    if len(h) < 2:
        return h.view(np.int64)
    at = np.arange(len(h))
    first = np.concatenate(([True], h[1:] != h[:-1]))
    copy = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.where(copy == 0, h, mix(h + copy.astype(np.uint64))).view(np.int64)


def _signatures(docs: list[np.ndarray], bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (``n x bands``) and a sketch of one bit a coordinate (``n x words``) of shingle arrays."""
    k = bands * rows
    keys, counts, owner = [], [], []
    for i, h in enumerate(docs):
        distinct, times = np.unique(h, return_counts=True)
        keys.append(distinct)
        counts.append(times)
        owner.append(np.full(len(distinct), i))
    signature = dart_minhash(np.concatenate(keys), np.concatenate(counts).astype(np.float64), np.concatenate(owner), len(docs), k)
    band = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(docs), 1))
    parts = signature.reshape(len(docs), bands, rows)
    for r in range(rows):
        band = mix(band * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    bits = (mix(signature) >> _U(63)).astype(np.uint8)
    sketch = np.packbits(np.pad(bits, ((0, 0), (0, -k % 64))), axis=1).view(np.int64)
    return band.view(np.int64), sketch


def signatures(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, print, n, bands, sketch`` of the rows ``id, text``.

    ``print`` is equal for texts of the same words (without any word: of the same text), ``n`` the
    number of shingles. A text without words has no bands.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints, docs = [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            prints.append(xxhash.xxh3_128_digest(" ".join(words) if words else "\0" + text))
            docs.append(shingles(words))
        sizes = np.array([len(d) for d in docs])
        band = np.zeros((len(docs), bands), np.int64)
        sketch = np.zeros((len(docs), -(-bands * rows // 64)), np.int64)
        group: list[int] = []
        held = 0
        for i in [*np.flatnonzero(sizes).tolist(), None]:
            if group and (i is None or len(group) == SETS_AT_ONCE or held + sizes[i] > ELEMENTS_AT_ONCE):
                band[group], sketch[group] = _signatures([docs[j] for j in group], bands, rows)
                group, held = [], 0
            if i is not None:
                group.append(i)
                held += sizes[i]
        none = sizes == 0
        offsets = np.concatenate(([0], np.cumsum(np.where(none, 0, bands))))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(band[~none].reshape(-1)))
        steps = np.arange(len(docs) + 1) * sketch.shape[1]
        bits = pa.ListArray.from_arrays(pa.array(steps, pa.int32()), pa.array(sketch.reshape(-1)))
        columns = [batch.column("id"), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()), lists, bits]
        return pa.RecordBatch.from_arrays(columns, ["id", "print", "n", "bands", "sketch"])

    schema = "id long, print binary, n long, bands array<long>, sketch array<long>"
    return map_texts(texts, run, schema, TEXTS_AT_ONCE, let_go=True)


# --- classes ------------------------------------------------------------------------------------


def _may_match(a: str, b: str, threshold: float, coordinates: int) -> Column:
    """False only where sizes rule the threshold out, or the sketches do by five standard errors.

    One-bit sketches of two sets of similarity s agree in (1 + s) / 2 of their bits.
    """
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    differing = F.lit(0)
    for k in range(-(-coordinates // 64)):
        differing = differing + F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k]))
    share = (1 - threshold) / 2
    bound = coordinates * share + 5 * (coordinates * share * (1 - share)) ** 0.5
    return (low >= high * F.lit(threshold)) & (differing <= F.lit(bound))


def element_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, elements`` of the texts whose id is in the one column of ``ids``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [elements_of(words_of(t)) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "elements"])

    made = map_texts(with_ids(texts, ids), run, "id long, elements array<long>", TEXTS_AT_ONCE, let_go=True)
    return stored(made, "elements")


def similar_pairs(pairs: DataFrame, texts: DataFrame, threshold: float, sets: DataFrame | None = None) -> DataFrame:
    """Those of the pairs ``a, b`` whose weighted Jaccard similarity is at least ``threshold``, computed exactly.

    Only texts that occur in a pair are fetched, and each end meets only those that it has; shingles travel to the pairs
    by joins on either end, whose skewed partitions (a text in very many pairs) adaptive execution splits.
    """
    pairs = stored(pairs, "pairs")
    if sets is None:
        sets = element_sets(texts, pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))))
    left = with_ids(sets, pairs.select("a")).select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = with_ids(sets, pairs.select("b")).select(F.col("id").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("x", "y"))
    similar = common >= F.lit(threshold) * (F.size("x") + F.size("y") - common)
    return stored(both.filter(similar).select("a", "b"), "similar")


def rarest_elements(sets: DataFrame, facts: DataFrame, threshold: float) -> DataFrame:
    """The rarest elements of each set, one of which it shares with every set of another component that is as similar as the threshold.

    ``sets`` has ``id, component, elements``, ``facts`` has ``id`` and what is known of a set, ``f.n`` its size among it. An
    element that no two components have cannot link them; of two sets these come first, then the others by the number
    of sets that have them, so a passage in very many sets does not bring these together. Of two such sets at least
    ``threshold * n`` elements of either are common, so they share one of the first ``n - ceil(threshold * n) + 1`` of each.

    A row for each of those that several components have: ``before`` is how many of the set's elements come before it,
    ``alone`` how many no other component has, ``parity`` a bit for each of ``64 * PARITY`` classes of the
    others, set where their number is odd. ``over`` is ``before`` less what the set may bring to the difference of a pair.
    """
    each = sets.select("id", "component", F.explode("elements").alias("element"))
    seen = each.groupBy("element").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = seen.filter("low < high").select("element", "df")
    ordered = each.select("id", "element").join(shared, "element")
    odd = [_parity(w) for w in range(PARITY)]
    ordered = ordered.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("s"), *odd)
    rows = ordered.join(facts, "id").withColumn("alone", F.col("f.n") - F.size("s"))
    first = F.col("f.n") - F.ceil(F.col("f.n") * F.lit(threshold) - F.lit(1e-9)) + 1
    rows = rows.withColumn("kept", (first - F.col("alone")).cast("int")).filter("kept > 0")
    rows = rows.withColumn("parity", F.array(*[f"parity{w}" for w in range(PARITY)]))
    rows = rows.select("id", "f", "alone", "parity", F.posexplode(F.slice("s", F.lit(1), F.col("kept"))).alias("at", "e"))
    rows = rows.select("id", "f", "alone", "parity", (F.col("alone") + F.col("at")).alias("before"), F.col("e.element").alias("element"))
    return rows.withColumn("over", F.col("before") - F.col("f.n") * F.lit(_difference(threshold)))


def _parity(word: int) -> Column:
    """One word of the parities of a set's elements."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("element", 8).bitwiseAND(F.lit(63)).cast("int"))
    mine = F.col("element").bitwiseAND(F.lit(PARITY - 1)) == word
    return F.bit_xor(F.when(mine, bit).otherwise(F.lit(0).cast("long"))).alias(f"parity{word}")


def _difference(threshold: float) -> float:
    """Two sets are as similar as ``threshold`` if and only if no more than this share of both sizes is in one of them only."""
    return (1 - threshold) / (1 + threshold)


def rare_pairs(rare: DataFrame, threshold: float, coordinates: int) -> DataFrame:
    """Pairs ``a, b`` of rows of ``rarest_elements`` (with ``component, outside``) that may be as similar as the threshold.

    At the first element that two sets have in common, what comes before it in either is in one of them only. So the
    pair is ruled out if ``over`` adds up to more than 0, and one of the two must have no more than 0 there: rows
    that have more meet only rows that have not. What no other component has, with the classes whose parities
    differ, is a bound of the difference too. Neither bound drops a pair that is similar; the members of a large group that
    lie just below the threshold are mostly apart by them before a pair is made.
    """
    x, y = rare.filter("over <= 1e-6").alias("x"), rare.alias("y")
    odd = F.lit(0)
    for w in range(PARITY):
        odd = odd + F.bit_count(F.col("x.parity")[w].bitwiseXOR(F.col("y.parity")[w]))
    allowed = (F.col("x.f.n") + F.col("y.f.n")) * F.lit(_difference(threshold)) + F.lit(1e-6)
    found = x.join(
        y,
        (F.col("x.element") == F.col("y.element"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.col("x.outside") | F.col("y.outside"))
        & ((F.col("x.id") < F.col("y.id")) | (F.col("y.over") > 1e-6))
        & (F.col("x.before") + F.col("y.before") <= allowed)
        & (F.col("x.alone") + F.col("y.alone") + odd <= allowed)
        & _may_match("x.f", "y.f", threshold, coordinates),
    )
    return found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_duplicate_classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, class_id`` for every document: its class of linked texts, named by the smallest id.

    Two texts are linked if the weighted Jaccard similarity of their runs of five words (lower case,
    without punctuation) is at least ``threshold``; a class is a connected component.

    1. Texts of the same words collapse to the one of smallest id.
    2. Texts that share a band meet in a bucket, whose lead is the text that meets most others in all its
       buckets: near the middle of a group of copies. Each text is compared with one lead, the foremost of its
       buckets, which joins most of a large group with as many pairs as it has texts.
    3. It is then compared with the lead of each bucket whose component is another than its own.
    4. Texts of buckets that still hold several components are compared with those of another component, if
       they share one of their rarest shingles (see ``rarest_elements``) and the bounds of ``rare_pairs`` allow it. No link
       between components of a bucket is left out, and none within a component is looked for.

    A null or empty text, or one without words, is linked only to equal texts. Rows that repeat an id are one document, of
    the smallest of their texts; rows without an id are left out.
    """
    texts = id_and_text(docs, id_col, text_col).filter("id is not null")
    made = stored(signatures(texts, bands, rows), "signatures")
    repeated = stored(made.groupBy("id").count().filter("count > 1").select("id"), "repeated-ids")
    if repeated.head(1):
        single = with_ids(texts, repeated).groupBy("id").agg(F.min("text").alias("text"))
        texts = without_ids(texts, repeated).unionAll(single)
        made = stored(without_ids(made, repeated).unionAll(signatures(single, bands, rows)), "signatures")
    copies = stored(made.groupBy("print").agg(F.min("id").alias("rep")), "copies")
    reps = copies.select(F.col("rep").alias("id"))
    chosen = stored(made.join(reps, "id", "left_semi").select("id", "n", "bands", "sketch"), "representatives")

    in_bands = chosen.select("id", F.explode("bands").alias("bucket"))
    sizes = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(in_bands.join(sizes, "bucket"), "buckets")
    degrees = shared.groupBy("id").agg((F.sum("size") * F.lit(1.0)).alias("degree"))
    ranked = shared.join(degrees, "id").select("bucket", "id", F.struct("degree", (-F.col("id")).alias("neg")).alias("rank"))
    leads = ranked.groupBy("bucket").agg(F.max("rank").alias("rank"))
    member = stored(shared.join(leads, "bucket").select("bucket", "id", "rank", (-F.col("rank.neg")).alias("lead")), "members")
    facts = chosen.select("id", F.struct("n", "sketch").alias("f"))

    def compared(pairs: DataFrame) -> DataFrame:
        seen = pairs.join(facts.select(F.col("id").alias("b"), F.col("f").alias("g")), "b")
        seen = seen.join(facts.select(F.col("id").alias("a"), F.col("f")), "a")
        return similar_pairs(seen.filter(_may_match("f", "g", threshold, bands * rows)).select("a", "b"), texts, threshold)

    def placed(linked: DataFrame) -> DataFrame:
        """The members of buckets with their component and that of the bucket's lead."""
        part = member.join(linked, "id", "left").select("bucket", "id", "lead", F.coalesce("component", "id").alias("component"))
        first = linked.select(F.col("id").alias("lead"), F.col("component").alias("main"))
        return part.join(first, "lead", "left").withColumn("main", F.coalesce("main", "lead"))

    def joined(linked: DataFrame, more: DataFrame) -> DataFrame:
        if not more.head(1):
            return linked
        return connected_components(linked.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more))

    nearest = member.filter("id <> lead").groupBy(F.col("id").alias("b")).agg(F.max("rank").alias("rank"))
    nearest = stored(nearest.select((-F.col("rank.neg")).alias("a"), "b"), "nearest")
    linked = connected_components(compared(nearest))
    stars = placed(linked).filter("component <> main").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    linked = joined(linked, compared(stars.join(nearest, ["a", "b"], "left_anti")))

    part = stored(placed(linked), "parts")
    torn = part.filter("component <> main").select("bucket").distinct()
    open_ids = part.join(torn, "bucket", "left_semi").groupBy("id", "component")
    open_ids = stored(open_ids.agg(F.max(F.col("component") != F.col("main")).alias("outside")), "open")
    if open_ids.head(1):
        sets = element_sets(texts, open_ids.select("id"))
        known = open_ids.hint("broadcast") if open_ids.count() <= BROADCAST_ROWS else open_ids
        rare = rarest_elements(sets.join(known.select("id", "component"), "id"), facts.join(known.select("id"), "id"), threshold)
        across = rare_pairs(stored(rare.join(known, "id"), "rarest"), threshold, bands * rows)
        linked = joined(linked, similar_pairs(across, texts, threshold, sets))

    classes = copies.join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.select("print", F.coalesce("component", "rep").alias("class_id"))
    return made.select("id", "print").join(classes, "print").select(F.col("id").alias("doc_id"), "class_id")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document of smallest id of every class, with all its columns; rows without an id are kept.

    Of rows that repeat an id, one stays.
    """
    classes = near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **options)
    classes = stored(classes, "classes")
    times = docs.filter(col(id_col).isNotNull()).groupBy(col(id_col).cast("long").alias("id")).count().filter("count > 1")
    repeated = stored(times.select("id"), "repeated-ids")
    copies = classes.filter("doc_id <> class_id").select(F.col("doc_id").alias("id"))
    kept = without_ids(docs, copies.unionAll(repeated), id_col)
    if repeated.head(1):
        again = with_ids(without_ids(docs, copies, id_col), repeated, id_col).dropDuplicates([id_col])
        kept = kept.unionAll(again)
    return kept
