"""Phrase collocations by best-first branch-and-bound growth.

A phrase of two to five words scores, at each cut into a first part and a rest, ``FACTOR``
times its count times the language's word count over the product of the parts' counts,
rounded down; its weakest cut is its score.  As a phrase is never more frequent than a part
of it, no phrase scores more than ``FACTOR * n / f`` for the count ``f`` of its first word,
nor for that of its last.  These bounds order the frontier: a wave takes the words of the
highest bounds, grows phrases to the right of them and to the left of them, one word a
level, and goes on from those that are frequent enough.  A phrase whose two ends are both
taken thereby has the counts of all its first parts, all its rests and all its extensions
by a word.  Once a language has its ``top`` surviving scores, every word whose bound
reaches the last of them is taken; when none is left, the language is settled, ties
included, and the next wave leaves it out.  With fewer survivors the frontier grows until
all frequent words are taken.

Texts are read once, into parts of word numbers.  A part names each phrase it sees once a
level, with its count there, and is told which are frequent in the whole language, so the
shuffle grows with the distinct phrases of a part, no table of phrases is broadcast and no
task grows with a frequent word or a long language.

Null text is empty, a null language ``und``.  Long texts are cut at blanks while they are
read.  Ties end with the phrase in byte order.  Repeated rows count each; other columns are
left out; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .shared import arrow_map, from_planes, planes, slices, stored, utf8

LONGEST = 5
FACTOR = 1000
LEAST = 100  # occurrences of a phrase
SHARE = 100  # a phrase goes if a longer one has so many percent of its count
TOP = 2000
WAVE, GROWTH = 32_000, 8  # words of the first wave, and by how much later ones grow
PART_WORDS = 1 << 20
TEXT_BYTES = 1 << 20

# Letters A-Z fall, ends of pieces become one sign that no word holds, tabs blanks.
ENDS = b".,;:!?\n\v\f\r"
TABLE = bytes(46 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

PART = pa.schema([
    ("part", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())),
    ("counts", pa.list_(pa.int64())), ("ids", pa.binary()),
])
PART_TYPE = "part long, lang string, n_words long, words array<string>, counts array<long>, ids binary"
STATE = pa.schema([
    ("part", pa.int64()), ("ids", pa.binary()), ("gids", pa.list_(pa.int64())), ("taken", pa.binary()), ("at", pa.binary()),
    ("slots", pa.binary()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
STATE_TYPE = "part long, ids binary, gids array<long>, taken binary, at binary, slots binary, left array<long>, right array<long>, counts array<long>"


class Words(dict):
    """Numbers of the words met so far; the sign between pieces has none."""

    def __init__(self):
        super().__init__({b".": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


def word_ids(text: bytes, words: Words) -> Iterator[np.ndarray]:
    """Word numbers of a text, -1 between pieces and at its end."""
    text, start = text.translate(TABLE), 0
    while start < len(text):
        end = start + TEXT_BYTES
        ends = [x for x in (text.find(b" ", end), text.find(b".", end)) if x >= 0]
        end = min(ends, default=len(text))
        found = text[start:end].replace(b".", b" . ").split()
        yield np.fromiter(map(words.__getitem__, found), np.int32, len(found))
        start = end
    yield np.array([-1], np.int32)


def parts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Rows of a language's documents: distinct words with counts, and the word numbers.
    Numbers of parts are unique in a table that is written once."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, sizes = TaskContext.get().partitionId() << 32, {}, {}

        def row(name: str) -> pa.RecordBatch:
            nonlocal number
            words, ids = held.pop(name)
            ids, number = np.concatenate(ids), number + 1
            counts = np.bincount(ids[ids >= 0], minlength=len(words) - 1)
            sizes.pop(name)
            values = [number - 1, name, int(counts.sum()), None, counts, planes(ids)]
            columns = [pa.array([v], f.type) for v, f in zip(values, PART)]
            names = pa.array(list(words)[1:], pa.binary()).cast(pa.string())
            columns[3] = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            return pa.RecordBatch.from_arrays(columns, schema=PART)

        for batch in slices(batches):
            for name, value in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words, ids = held.setdefault(name, (Words(), []))
                found = list(word_ids(value, words))
                ids.extend(found)
                sizes[name] = sizes.get(name, 0) + sum(map(len, found))
                if sizes[name] >= PART_WORDS:
                    yield row(name)
                elif sum(sizes.values()) >= 4 * PART_WORDS:
                    yield row(max(sizes, key=sizes.get))
        for name in list(held):
            yield row(name)

    return arrow_map(docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")), docs[text].cast("string")), work, PART_TYPE)


def grown(ids: np.ndarray, taken: np.ndarray, alive: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrases of ``length + 1`` words that may be frequent: where each starts, its number
    among the distinct ones, and of these: what it grows from, the word, the count.

    ``alive`` holds, per place, the number of the frequent phrase of ``length`` words that
    starts there, or -1.  A phrase grows from the phrase without its last word if its first
    word is taken, else from the one without its first word, marked in the lowest bit.
    """
    first, last = ids[:-length], ids[length:]
    here, after = alive[: len(first)], alive[1:len(first) + 1]
    forward, backward = taken[first] & (first >= 0), taken[last] & (last >= 0)
    good = (first >= 0) & (last >= 0) & (forward | backward) & (~forward | (here >= 0)) & (~backward | (after >= 0))
    at = np.flatnonzero(good)
    side = ~forward[at]
    parent, word = np.where(side, after[at], here[at]).astype(np.int64), np.where(side, first[at], last[at]).astype(np.int64)
    keys, slots, counts = np.unique((parent * 2 + side) << 31 | word, return_inverse=True, return_counts=True)
    return at, slots.ravel(), keys >> 31, keys & (1 << 31) - 1, counts


def state_row(part: int, ids: np.ndarray, gids: np.ndarray, taken: np.ndarray, alive: np.ndarray, names: np.ndarray, length: int) -> pa.Table:
    """A part with its phrases of ``length + 1`` words; ``names`` are the ids of those of
    ``length`` words.  Places of two-word phrases, the many, are found again when needed."""
    at, slots, parent, word, counts = grown(ids, taken, alive, length)
    # Words that no such phrase holds or could grow by at any later level become breaks,
    # one for many.  It grows to the right if its first word is taken, to the left if its last is.
    start = np.where(taken[ids[at + length]], np.maximum(at + length + 1 - LONGEST, 0), at)
    end = np.where(taken[ids[at]], np.minimum(at + LONGEST, len(ids)), at + length + 1)
    near = np.zeros(len(ids) + 1, np.int64)
    np.add.at(near, start, 1)
    np.add.at(near, end, -1)
    left = np.where(np.cumsum(near[:-1]) > 0, ids, -1)
    stays = (left >= 0) | np.append(True, left[:-1] >= 0)
    at = np.diff((np.cumsum(stays) - 1)[at], prepend=0)
    values = [
        part, planes(left[stays]), gids, taken[:-1].tobytes(), planes(at) if length > 1 else None,
        planes(slots) if length > 1 else None, names[parent >> 1] * 2 + (parent & 1), gids[word], counts,
    ]
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, STATE)], schema=STATE)


def begin(left: pa.Table, right: pa.Table) -> pa.Table:
    """A part and its frequent words -> phrases of two words.  Words of at most ``limit``
    occurrences are taken."""
    if not left.num_rows or not right.num_rows:
        return STATE.empty_table()
    raw = from_planes(left.column("ids")[0].as_py())
    place, gids = right.column("place").to_numpy(), right.column("gid").to_numpy()
    order = np.argsort(gids)  # phrases come in this order, so their ids repeat and pack well
    frequent = np.full(max(int(raw.max(initial=0)), int(place.max())) + 2, -1, np.int32)
    frequent[place[order]] = np.arange(len(place), dtype=np.int32)
    ids = frequent[raw]  # the last entry answers for -1
    taken = np.append(right.column("f").to_numpy()[order] <= left.column("limit")[0].as_py(), False)
    return state_row(left.column("part")[0].as_py(), ids, gids[order], taken, np.append(ids, -1), gids[order], 1)


def go_on(length: int):
    """A part and its frequent phrases of ``length`` words -> phrases of one word more."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return STATE.empty_table()
        one = {n: left.column(n)[0] for n in ("part", "ids", "gids", "taken", "at", "slots", "size")}
        ids, taken = from_planes(one["ids"].as_py()), np.append(np.frombuffer(one["taken"].as_py(), bool), False)
        if length == 2:
            at, slots = grown(ids, taken, np.append(ids, -1), 1)[:2]
        else:
            at, slots = np.cumsum(from_planes(one["at"].as_py())), from_planes(one["slots"].as_py())
        place, names = right.column("place").to_numpy(), right.column("gid").to_numpy()
        frequent = np.full(one["size"].as_py(), -1, np.int32)
        frequent[place] = np.arange(len(place), dtype=np.int32)
        alive = np.full(len(ids) + 1, -1, np.int32)
        alive[at] = frequent[slots]
        return state_row(one["part"].as_py(), ids, one["gids"].values.to_numpy(), taken, alive, names, length)

    return work


def with_total(seen: DataFrame, least: int, *key: str) -> DataFrame:
    """Rows of parts whose ``counts`` add up to ``least`` or more for their key, with the
    sum ``f`` and a number of the key, ``gid``: the ``row`` of one of its rows.  A key has a
    row per part at most, and all meet in one shuffle.  Numbers hold in a table that is
    written once."""
    of_key = Window.partitionBy(*key)
    numbered = seen.withColumn("row", F.monotonically_increasing_id())
    total = numbered.withColumns({"f": F.sum("counts").over(of_key), "gid": F.min("row").over(of_key)})
    return total.where(F.col("f") >= least).drop("counts")


def keys_of(hits: DataFrame, *columns: str) -> DataFrame:
    """The columns once for each key of ``with_total``."""
    return hits.where(F.col("row") == F.col("gid")).select(*columns)


def frequent_phrases(found: DataFrame, vocabulary: DataFrame, words: DataFrame, limits: DataFrame, least: int, some: bool) -> DataFrame:
    """``lang``, ``words``, ``f``, ``first_f``, ``last_f`` of all frequent phrases with an
    end of at most ``limit`` occurrences, single words included.  ``some``: ``limits`` may
    lack languages, whose parts are left out."""
    left = found.select("part", "lang", "ids").join(limits.select("lang", "limit"), "lang").select("part", "ids", "limit")
    right = vocabulary.select(F.col("part").alias("of_part"), "lang", "place", "gid", "f")
    right = (right.join(limits.select("lang"), "lang", "left_semi") if some else right).drop("lang")
    state = stored(left.groupBy("part").cogroup(right.groupBy("of_part")).applyInArrow(begin, STATE_TYPE), "phrases-2")
    single = words.join(limits.select("lang"), "lang", "left_semi").select(
        "gid", "lang", F.array("word").alias("words"), "f", F.col("f").alias("first_f"), F.col("f").alias("last_f")
    )
    levels = [single]
    word = words.select(F.col("gid").alias("right"), "word", F.col("f").alias("word_f"))
    for length in range(2, LONGEST + 1):
        seen = state.select("part", F.posexplode(F.arrays_zip("left", "right", "counts")).alias("place", "p")).select("part", "place", "p.*")
        hits = stored(with_total(seen, least, "left", "right"), f"hits-{length}")
        level = keys_of(hits, "left", "right", "f", "gid")
        back = F.col("left").bitwiseAND(F.lit(1)) == 1
        grown = level.withColumnRenamed("f", "own_f").withColumnRenamed("gid", "own").withColumn("gid", F.shiftright("left", 1)).join(levels[-1], "gid").join(word, "right")
        levels.append(grown.select(
            F.col("own").alias("gid"), "lang",
            F.when(back, F.concat(F.array("word"), "words")).otherwise(F.concat("words", F.array("word"))).alias("words"),
            F.col("own_f").alias("f"), F.when(back, F.col("word_f")).otherwise(F.col("first_f")).alias("first_f"),
            F.when(back, F.col("last_f")).otherwise(F.col("word_f")).alias("last_f"),
        ))
        if length < LONGEST:
            hits = hits.select(F.col("part").alias("of_part"), "place", "gid")
            bare = state.select("part", "ids", "gids", "taken", "at", "slots", F.size("counts").alias("size"))
            state = stored(bare.groupBy("part").cogroup(hits.groupBy("of_part")).applyInArrow(go_on(length), STATE_TYPE), f"phrases-{length + 1}")
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return stored(every.drop("gid"), "phrases")


def text_of(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def survivors(phrases: DataFrame, limits: DataFrame, share: int) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the phrases with both
    ends taken that no longer phrase stands for."""
    size, words = F.size("words"), F.col("words")
    named = phrases.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    both = phrases.where(size > 1).join(limits.select("lang", "limit", "n"), "lang").where(F.greatest("first_f", "last_f") <= F.col("limit"))
    cuts = both.select("lang", "words", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "n", "k", text_of(words, F.lit(1), F.col("k")).alias("first"), text_of(words, F.col("k") + 1, F.size("words") - F.col("k")).alias("rest")
    )
    wide = "decimal(19,0)"
    cuts = cuts.join(named.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(named.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"(cast(a * {FACTOR} AS {wide}) * cast(n AS {wide})) div (cast(l AS {wide}) * cast(r AS {wide}))")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    inside = phrases.where(size > 2).select(
        "lang", "f", F.explode(F.array(text_of(words, F.lit(1), size - 1), text_of(words, F.lit(2), size - 1))).alias("phrase")
    )
    longer = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    return kept.select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP, wave: int = WAVE) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang``, ``rank`` from 1, ``phrase``, ``a``
    (its count), ``l`` and ``r`` (of the parts at its weakest cut), ``n`` and ``score``."""
    found = stored(parts(docs, text, lang), "word-parts")
    listed = found.select("part", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "p")).select("part", "lang", "place", F.col("p.words").alias("word"), "p.counts")
    vocabulary = stored(with_total(listed, least, "lang", "word"), "vocabulary")
    words = stored(keys_of(vocabulary, "lang", "word", "f", "gid"), "words")
    sizes = found.groupBy("lang").agg(F.sum("n_words").alias("n"))
    # Words by eighths of a power of two of their count: how many a limit takes.
    steps = words.groupBy("lang", F.floor(F.log2("f") * 8).alias("step")).agg(F.count("*").alias("words"), F.max("f").alias("high"))
    so_far = F.sum("words").over(Window.partitionBy("lang").orderBy("step"))
    steps = stored(steps.withColumn("taken", so_far).join(sizes, "lang"), "steps")

    def limits_for(open_: DataFrame) -> DataFrame:
        """``lang``, ``n``, ``limit``, ``most`` of languages with ``known``, the limit that is
        needed, or ``taking``, the number of words to take."""
        return steps.join(open_, "lang").groupBy("lang", "n").agg(
            F.least(F.coalesce(F.max("known"), F.min(F.when(F.col("taken") >= F.col("taking"), F.col("high"))), F.max("high")), F.max("high")).alias("limit"),
            F.max("high").alias("most"),
        )

    limits = stored(limits_for(steps.select("lang", F.lit(None).cast("long").alias("known"), F.lit(wave).cast("long").alias("taking")).distinct()), "limits")
    done = None
    while True:
        scored = survivors(frequent_phrases(found, vocabulary, words, limits, least, done is not None), limits, share)
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = stored(scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "ranked")
        # A language is settled once no word is left whose bound reaches its last score.
        last = ranked.where(F.col("rank") == top).select("lang", F.expr(f"cast((cast({FACTOR} AS decimal(19,0)) * cast(n AS decimal(19,0))) div nullif(score, 0) AS bigint)").alias("known"))
        open_ = limits.join(last, "lang", "left").where(F.col("limit") < F.least(F.coalesce("known", "most"), "most"))
        wave *= GROWTH
        next_ = stored(limits_for(open_.select("lang", "known", F.lit(wave).cast("long").alias("taking"))), "limits")
        settled = ranked.join(next_.select("lang"), "lang", "left_anti").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        done = settled if done is None else done.unionByName(settled)
        if next_.isEmpty():
            return done
        limits = next_
