"""Grouped prefix join: documents whose shingle sets have a Jaccard similarity above a limit.

Every set is put into one global order, rare shingles first. Two similar sets of sizes that fit
then share one of the first few shingles, the prefix. Documents with equal sets are one class,
classes of equal size and prefix one group, and only groups meet by shingle. Members are
verified with their whole sets.

The result is components, so not all pairs of a large family are made. First each group is tried
against its neighbours and the centre of every shingle's list. What links then is one component,
and only groups of different components that share a shingle are tried in a second pass. Every
link either lies inside a component or is found there.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.components import connected_components
from pagelore.llm.storage import stage, temporaries
from pagelore.llm.texthash import PART_BYTES, slices, text_shingles
from pagelore.operators.prefilter import MOST_BYTES, key_filter, maybe_in

#: The global order counts shingles in so many buckets; the table has a fixed size of 4 MB.
BUCKET_BITS = 20
#: A set's signature has a bit for each of so many classes of shingles: whether it holds an odd
#: number of them. Signatures differ in no more bits than sets in shingles.
SIGNATURE_BITS = 512
#: The list of a shingle is cut into parts by hash, one more for each time that its bucket is so
#: many times as full as the mean, so that no task gets the whole list of a hot one.
HOT = 8


@dataclass(frozen=True)
class Similarity:
    """Sets of ``k``-word shingles, alike if 100 * intersection >= percent * union."""

    k: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        """How many shingles of a set of n must be looked at; 0 for the empty set."""
        return n - -(-n * self.percent // 100) + 1 if n else 0

    def alike(self, common: int, n: int, m: int) -> bool:
        return 100 * common >= self.percent * (n + m - common)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def shingle_counts(docs: DataFrame, like: Similarity) -> np.ndarray:
    """In how many documents the shingles of each bucket stand, over all documents.

    Every task counts into a table of one fixed size; the tables are added up in two levels.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0, PART_BYTES):
                sets = text_shingles(part.column(0), like.k)
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=len(counts))
        yield _packed(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                counts += np.frombuffer(raw.as_buffer(), dtype="<u4")
        yield _packed(counts)

    partial = stage(docs.select(F.col("text").cast("string")).mapInArrow(count, "counts binary"), "shingle-counts")
    width = max(1, round(partial.count() ** 0.5))
    sums = stage(partial.repartition(width).mapInArrow(add, "counts binary"), "shingle-counts")
    whole = sums.repartition(1).mapInArrow(add, "counts binary").first()
    return np.frombuffer(whole["counts"], dtype="<u4").copy()


def _packed(counts: np.ndarray) -> pa.RecordBatch:
    """One row; a count that runs over stays at the greatest value."""
    raw = np.minimum(counts, 0xFFFFFFFF).astype("<u4").tobytes()
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["counts"])


def _set_key(shingles: np.ndarray) -> int:
    """63 bits that stand for a set, with its size mixed in."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) >> 1


def _set_check(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), seed=1) >> 1


def _signature(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount(shingles.view(np.int64) & (SIGNATURE_BITS - 1), minlength=SIGNATURE_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def prefixes(docs: DataFrame, like: Similarity, counts: np.ndarray) -> DataFrame:
    """(row, doc_id, text_hash, n, set_key, set_check, prefix, parts, signature), one row a
    document.

    Both hashes together name the set; the prefix has its rarest shingles, rarest first, and
    ``parts`` says into how many parts the list of each is cut.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)  # 4 MB at any size of the input
    step = max(4096, HOT * int(counts.mean()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        rare = shared.value
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                sets = text_shingles(part.column(1), like.k)
                firsts, parts = [], []
                for s in sets:
                    count = rare[_bucket(s)]
                    order = np.lexsort((s, count))[: like.prefix(len(s))]
                    firsts.append(s[order].view(np.int64))
                    parts.append((count[order] // step + 1).astype(np.int32))
                edges = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + part.num_rows)), part.column(0), part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_key(s) for s in sets], pa.int64()),
                        pa.array([_set_check(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(edges, pa.array(np.concatenate(firsts))),
                        pa.ListArray.from_arrays(edges, pa.array(np.concatenate(parts))),
                        pa.array([_signature(s) for s in sets], pa.list_(pa.int64())),
                    ],
                    [
                        "row", "doc_id", "text_hash", "n", "set_key", "set_check", "prefix", "parts",
                        "signature",
                    ],
                )
                row += part.num_rows

    text = F.col("text").cast("string")
    wanted = docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash"))
    return wanted.mapInArrow(
        run,
        "row long, doc_id long, text_hash long, n long, set_key long, set_check long,"
        " prefix array<long>, parts array<int>, signature array<long>",
    )


def set_classes(found: DataFrame) -> DataFrame:
    """(class, set_key, set_check, n, copies, doc_key, text_hash, prefix, parts, signature, grp):
    one row for each different set but the empty one. ``class`` is its smallest row, with that
    row's id and text hash; ``copies`` is the number of rows; ``grp`` is the smallest class of
    equal size and prefix.
    Prefixes are compared by their hash: should two agree by chance, a group has a member more to
    verify."""
    classes = found.where("n > 0").groupBy("set_key", "set_check", "n").agg(
        F.min(F.struct("row", "doc_id", "text_hash", "prefix", "parts", "signature")).alias("first"),
        F.count("*").alias("copies"),
    )
    classes = stage(
        classes.select(
            F.col("first.row").alias("class"), "set_key", "set_check", "n", "copies",
            _doc_key("first.doc_id"), "first.text_hash", "first.prefix", "first.parts", "first.signature",
            F.xxhash64("first.prefix").alias("prefix_hash"),
        ),
        "set-classes",
    )
    groups = classes.groupBy("n", "prefix_hash").agg(
        F.min("class").alias("grp"), F.count("*").alias("members")
    )
    shared = stage(
        groups.where("members > 1").select(
            F.col("n").alias("group_n"), F.col("prefix_hash").alias("group_hash"), "grp"
        ),
        "prefix-groups",
    )
    joined = classes.join(
        shared, (F.col("n") == F.col("group_n")) & (F.col("prefix_hash") == F.col("group_hash")), "left"
    )
    return joined.select(
        "class", "set_key", "set_check", "n", "copies", "doc_key", "text_hash", "prefix", "parts",
        "signature", F.coalesce("grp", "class").alias("grp"),
    )


def _postings(classes: DataFrame) -> DataFrame:
    """(shingle, part, place, copies, class), one row for each shingle of a prefix.

    ``place`` packs the size of the set, the position in it, and whether the list has parts.
    """
    rows = classes.select(
        "class", "n", "copies", F.posexplode(F.arrays_zip("prefix", "parts")).alias("pos", "x")
    )
    many = (F.col("x.parts") > 1).cast("long")
    return rows.select(
        F.col("x.prefix").alias("shingle"),
        F.pmod(F.xxhash64("class"), F.col("x.parts")).cast("int").alias("part"),
        (F.shiftleft("n", 32) + F.col("pos") * 2 + many).alias("place"), "copies", "class",
    )


def _size(place) -> Column:
    return F.shiftright(place, 32)


def _position(place) -> Column:
    return F.shiftright(place.bitwiseAND(F.lit(0xFFFFFFFF)), 1)


def _in_parts(place) -> Column:
    return place.bitwiseAND(F.lit(1)) == 1


def shared_postings(classes: DataFrame, like: Similarity) -> DataFrame:
    """(shingle, part, place, class, other, centre): prefixes of the groups, as far as the list
    of a shingle can hold two sets that are alike.

    ``other`` has place and class of the neighbour before in the list, which is sorted by size
    and cut into parts; ``centre`` of the group with the most copies and then the smallest
    position: edited copies have their own shingles before those of their original. The
    smaller of two similar sets has a shared shingle so near to its start (``early``) that a
    list without such a place is left out.
    """
    list_of = Window.partitionBy("shingle", "part")
    order = list_of.orderBy("place", "class")
    me = F.struct("place", "class")
    size, position = _size(F.col("place")), _position(F.col("place"))
    early = (100 + like.percent) * (size - position) >= 2 * like.percent * size
    walked = _postings(classes.where("class = grp")).select(
        "shingle", "part", "place", "class", F.lag(me).over(order).alias("other"),
        F.max(F.struct("copies", -position, "place", "class")).over(list_of).alias("best"),
        F.max(early).over(list_of).alias("early"), F.count("*").over(list_of).alias("members"),
    )
    useful = (F.col("early") & (F.col("members") > 1)) | _in_parts(F.col("place"))
    centre = F.struct("best.place", "best.class").alias("centre")
    return walked.where(useful).select("shingle", "part", "place", "class", "other", centre)


def _may_link(like: Similarity, left, right) -> Column:
    """Whether sizes and the places of a shared shingle allow two sets to be alike.

    For the first shingle that both share, what is left behind the places bounds what they have
    in common.
    """
    n, m = _size(left), _size(right)
    common = 1 + F.least(n - _position(left) - 1, m - _position(right) - 1)
    fits = 100 * F.least(n, m) >= like.percent * F.greatest(n, m)
    return fits & ((100 + like.percent) * common >= like.percent * (n + m))


def first_pairs(lists: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """(a, b) classes to try first, so that most of what belongs together is one component.

    Tried are neighbours in the list of a shingle, every group of a list with the list's centre,
    and members of a group with its first class. Edited copies link with their original rather
    than with each other. The centres of a list's parts make a list again. The number of pairs
    grows with the postings, whatever the length of a list.
    """
    centres = lists.where(_in_parts(F.col("place"))).groupBy("shingle", "part").agg(
        F.first("centre").alias("centre")
    )
    across = centres.select(
        F.col("centre.place").alias("place"), F.col("centre.class").alias("class"),
        F.lag("centre").over(Window.partitionBy("shingle").orderBy("centre")).alias("other"),
    )
    around = lists.select("place", "class", F.col("centre").alias("other"))
    near = lists.select("place", "class", "other").unionByName(around).unionByName(across)
    tried = near.where("other is not null and class <> other.class").where(
        _may_link(like, F.col("place"), F.col("other.place"))
    )
    between = tried.select(
        F.least("class", "other.class").alias("a"), F.greatest("class", "other.class").alias("b")
    )
    members = classes.where("class <> grp").select(F.col("grp").alias("a"), F.col("class").alias("b"))
    return plausible(between.unionByName(members).distinct(), classes, like)


def plausible(pairs: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (a, b) whose signatures allow them to be alike; no alike pair is lost.

    Alike sets of sizes n and m differ in at most n + m - 2 * least common shingles.
    """
    x, y = (
        classes.select(
            F.col("class").alias(f"{side}_class"), F.col("n").alias(f"{side}_n"),
            F.col("signature").alias(f"{side}_bits"),
        )
        for side in "xy"
    )
    both = pairs.join(x, F.col("a") == F.col("x_class")).join(y, F.col("b") == F.col("y_class"))
    sizes = F.col("x_n") + F.col("y_n")
    allowed = sizes * (100 - like.percent) / (100 + like.percent)
    unlike = F.zip_with("x_bits", "y_bits", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differing = F.aggregate(unlike, F.lit(0), lambda done, n: done + n)
    return both.where(differing <= F.floor(allowed + 1e-6)).select("a", "b")


def needed_texts(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """(class, zipped): the whole texts of the classes in (a, b), compressed.

    Texts are moved instead of sets, since hashes do not compress. A class is found by its first
    document's id and text. A filter of these, sized by their number up to ``most_bytes``, leaves
    other texts out where they are read; documents that pass it by chance do no harm.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct()
    wanted = classes.join(ends, F.col("class") == F.col("end"), "semi").select(
        "class", F.col("doc_key").alias("k"), F.col("text_hash").alias("h"),
        F.xxhash64("doc_key", "text_hash").alias("place"),
    )
    wanted = stage(wanted, "wanted-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor()
        for batch in batches:
            for part in slices(batch, 0, PART_BYTES):
                zipped = pa.array([codec.compress(x.as_buffer()) for x in part.column(0)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), zipped], ["doc_key", "text_hash", "zipped"]
                )

    text = F.col("text").cast("string")
    named = docs.where(text.isNotNull()).select(
        text.alias("text"), _doc_key("doc_id"), F.xxhash64(text).alias("text_hash")
    ).withColumn("place", F.xxhash64("doc_key", "text_hash"))
    held = maybe_in(named, "place", key_filter(wanted, "place", most_bytes))
    found = held.mapInArrow(run, "doc_key long, text_hash long, zipped binary")
    one = found.groupBy("doc_key", "text_hash").agg(F.first("zipped").alias("zipped"))
    both = one.join(wanted, (F.col("doc_key") == F.col("k")) & (F.col("text_hash") == F.col("h")))
    return both.select("class", "zipped")


def _doc_key(doc_id: str) -> Column:
    """The id with a value for null; with the text's hash it says which text is meant."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("doc_key")


def verified(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()

        def shingles(zipped: pa.Scalar) -> np.ndarray:
            raw = pa.array([codec.decompress(zipped.as_buffer())], pa.large_binary())
            return text_shingles(raw.view(pa.large_string()), like.k)[0]

        last = [(None, None), (None, None)]
        for batch in batches:
            hits = []
            for i in range(batch.num_rows):
                for side in (0, 1):  # pairs of one class follow each other
                    name = batch.column(side)[i].as_py()
                    if last[side][0] != name:
                        last[side] = (name, shingles(batch.column(side + 2)[i]))
                x, y = last[0][1], last[1][1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                hits.append(like.alike(common, len(x), len(y)))
            mask = pa.array(hits, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"]
            )

    left = texts.select(F.col("class").alias("left_class"), F.col("zipped").alias("left_text"))
    right = texts.select(F.col("class").alias("right_class"), F.col("zipped").alias("right_text"))
    both = pairs.join(left, F.col("a") == F.col("left_class")).join(right, F.col("b") == F.col("right_class"))
    return both.select("a", "b", "left_text", "right_text").mapInArrow(run, "a long, b long")


def remaining_pairs(
    lists: DataFrame, classes: DataFrame, parts: DataFrame, tried: DataFrame, like: Similarity
) -> DataFrame:
    """(a, b) of different components that may be alike and have not been tried.

    Components are those of the first pass. Only shingles that stand in several of them are
    looked at. Members of a group meet others on their own now.
    """
    leaders = lists.select("shingle", "place", "class")
    members = _postings(classes.where("class <> grp")).select("shingle", "place", "class")
    posts = leaders.unionByName(_with_leaders(members, classes, leaders)).join(
        parts, F.col("class") == F.col("node"), "left"
    )
    posts = stage(
        posts.select("shingle", "place", "class", F.coalesce("component", "class").alias("component")),
        "postings-left",
    )
    mixed = posts.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low <> high").select(F.col("shingle").alias("mixed"))
    left = stage(posts.join(mixed, F.col("shingle") == F.col("mixed"), "semi"), "postings-mixed")
    x, y = left.alias("x"), left.alias("y")
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.class") < F.col("y.class"))
        & (F.col("x.component") != F.col("y.component"))
        & _may_link(like, F.col("x.place"), F.col("y.place")),
    )
    pairs = met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    known = tried.select(F.col("a").alias("known_a"), F.col("b").alias("known_b"))
    new = pairs.join(known, (F.col("a") == F.col("known_a")) & (F.col("b") == F.col("known_b")), "anti")
    return plausible(new, classes, like)


def _with_leaders(members: DataFrame, classes: DataFrame, leaders: DataFrame) -> DataFrame:
    """Postings of group members and, where no other group has the shingle, of their leaders."""
    grouped = classes.where("class <> grp").select(F.col("grp").alias("led")).distinct()
    led = classes.join(grouped, F.col("class") == F.col("led"), "semi")
    known = leaders.select(F.col("class").alias("c"), F.col("shingle").alias("s"))
    alone = _postings(led).select("shingle", "place", "class").join(
        known, (F.col("class") == F.col("c")) & (F.col("shingle") == F.col("s")), "anti"
    )
    return members.unionByName(alone)


def similar_components(docs: DataFrame, like: Similarity) -> DataFrame:
    """(row, doc_id, text_hash, n_shingles, component_id, stays), one row a document.

    Words end at ASCII white space, A-Z count as a-z; a text of fewer than k words has its whole
    sequence as one shingle. Null and empty texts have no shingles and link with nothing.
    component_id is the smallest doc_id that links reach, the document's own included; ``stays``
    marks one row of each component, the smallest by doc_id. A null doc_id is larger than any
    other. Repeated rows are documents of their own. Columns other than doc_id and text are
    ignored.
    """
    with temporaries(docs.sparkSession):
        rows = stage(_with_components(docs, like), "rows", keep=True)
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    heads = rows.groupBy("component").agg(F.min(first).alias("head"))
    heads = stage(heads.select(F.col("component").alias("of"), "head"), "heads", keep=True)
    return rows.join(heads, F.col("component") == F.col("of")).select(
        "row", "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.col("head.doc_id").alias("component_id"), (F.col("row") == F.col("head.row")).alias("stays"),
    )


def _with_components(docs: DataFrame, like: Similarity) -> DataFrame:
    """(row, doc_id, text_hash, n, component); components are named by a class, or by the row
    where a document has no shingles."""
    found = stage(prefixes(docs, like, shingle_counts(docs, like)), "prefixes")
    classes = stage(set_classes(found), "classes")
    lists = stage(shared_postings(classes, like), "postings")
    pairs = stage(first_pairs(lists, classes, like), "pairs")
    texts = stage(needed_texts(docs, classes, pairs), "texts")
    links = stage(verified(pairs, texts, like), "links")
    parts = connected_components(links)
    more = stage(remaining_pairs(lists, classes, parts, pairs, like), "pairs")
    texts = stage(needed_texts(docs, classes, more), "texts")
    # Written first: else a task runs a Python worker for the sets and one for the links at once.
    left = stage(verified(more, texts, like), "links")
    parts = connected_components(links.unionByName(left))
    named = classes.join(parts, F.col("class") == F.col("node"), "left").select(
        F.col("set_key").alias("k"), F.col("set_check").alias("c"),
        F.coalesce("component", "class").alias("component"),
    )
    rows = found.select("row", "doc_id", "text_hash", "n", "set_key", "set_check").join(
        stage(named, "class-components"),
        (F.col("set_key") == F.col("k")) & (F.col("set_check") == F.col("c")), "left",
    )
    alone = F.lit(-1) - F.col("row")
    return rows.select("row", "doc_id", "text_hash", "n", F.coalesce("component", alone).alias("component"))


def without_near_duplicates(docs: DataFrame, like: Similarity) -> DataFrame:
    """All columns of the one document of each component that stays, and of all documents
    without words. Of rows equal in id and text one stands for all."""
    stays = similar_components(docs, like).where("stays and n_shingles > 0").select(
        F.col("doc_id").alias("keep_doc"), F.col("text_hash").alias("keep_hash")
    )
    stays = stage(stays, "stays", keep=True)
    text = F.col("text").cast("string")
    has_words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(has_words).select(
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_key"),
        F.xxhash64(text).alias("doc_hash"),
    )
    joined = keyed.join(
        stays,
        (F.col("doc_hash") == F.col("keep_hash")) & F.col("doc_key").eqNullSafe(F.col("keep_doc")),
        "semi",
    )
    one = joined.dropDuplicates(["doc_hash", "doc_key"]).select("doc.*")
    return one.unionByName(docs.where(~has_words))
