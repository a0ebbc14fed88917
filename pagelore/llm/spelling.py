"""Spelling variants: words one edit apart, by composing finite-state machines.

The vocabulary is an acceptor V, a transducer E maps a word to those one edit away, and the
paths of V o E o V are the pairs. No machine of the whole vocabulary is ever built. Two words one
edit apart share either their first half or the rest, so every word goes to the composed initial
states behind its first half and, read backwards, behind its second half. Spark deals these
states out; each task minimises the part of V below a state and composes it with E and itself.
A state with too many words below is expanded by one symbol and dealt out again.
"""

import zlib
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.llm.storage import stage, temporaries

#: Words with so many code points and occurrences make the vocabulary.
SHORTEST, RAREST = 5, 3
#: A form has at least so many times the occurrences of its variant.
RATIO = 2
#: More words than this below one initial state are dealt out further.
STATE_WORDS = 20_000
#: Doublings that follow any chain of forms to its end: occurrences at least double from one
#: form to the next and are 64-bit numbers.
DOUBLINGS = 6

_LETTERS = r"[A-Za-z\x{C0}-\x{FF}]+"
_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
_SHORT, _LONG, _TARGET = 0, 1, 2


def word_occurrences(
    docs: DataFrame, noise: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(word): maximal runs of Latin letters in all texts, A-Z in lower case, one row each.

    With ``noise``, a run whose crc32 of ``id:run`` it divides loses the code point at that
    number modulo its length. Null texts have no words, null ids count as empty.
    """
    text = F.translate(F.col(text_column).cast("string"), _UPPER, _LOWER)
    # explode_outer with a filter: for explode, Spark would run the pattern twice.
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode_outer(F.regexp_extract_all(text, F.lit(_LETTERS), F.lit(0))).alias("run"),
    ).where("run is not null")
    if noise is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))
    )
    return hashed.select(F.when(F.col("h") % noise == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    long_enough = words.where(F.char_length("word") >= shortest)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rarest)


class Acceptor:
    """Minimal acyclic acceptors, one for each root, in one set of states.

    Equal right languages are one state, so a state's number stands for what it accepts. Arcs
    carry how many words come before theirs: sums along a path give a word's rank.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self._known: dict[tuple, int] = {}

    def root(self, words: Iterable[str]) -> int:
        """Add ascending different words; the state that accepts them."""
        open_states: list[tuple[list[bool], list[tuple[str, int]]]] = [([False], [])]
        last = ""
        for word in words:
            same, limit = 0, min(len(last), len(word))
            while same < limit and last[same] == word[same]:
                same += 1
            self._close(open_states, last, same)
            open_states += [([False], []) for _ in range(len(word) - same)]
            open_states[-1][0][0] = True
            last = word
        self._close(open_states, last, 0)
        return self._state(*open_states[0])

    def _close(self, open_states: list, word: str, depth: int) -> None:
        while len(open_states) - 1 > depth:
            state = self._state(*open_states.pop())
            open_states[-1][1].append((word[len(open_states) - 1], state))

    def _state(self, final: list[bool], arcs: list[tuple[str, int]]) -> int:
        key = (final[0], *arcs)
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            before, table = int(final[0]), {}
            for symbol, to in arcs:
                table[symbol] = (to, before)
                before += self.count[to]
            self.arcs.append(table)
            self.final.append(final[0])
            self.count.append(before)
        return state


Pairs = list[tuple[int, int]]


class OneEdit:
    """V o E o V: pairs of ranks, found state by state.

    E has two states, before and after its edit. After it both sides read the same symbols:
    :meth:`after`. Before it both sides have read the same, and either go on or make the edit
    here. A deletion leaves out the first of equal symbols, so that each pair has one path.
    """

    def __init__(self, words: Acceptor) -> None:
        self._v = words
        self._after: dict[tuple[int, int], Pairs] = {}
        self._replaced: dict[int, Pairs] = {}
        self._deleted: dict[tuple[int, int], Pairs] = {}

    def replaced(self, root: int, here: bool) -> Pairs:
        """Pairs below one state that differ in one symbol, the smaller first; ``here``: in the
        first."""
        if here:
            return self._replace(root)
        return _solve(self._replaced, root, self._replace_next, self._replace_below)

    def deleted(self, long: int, short: int, here: bool, not_here: str | None) -> Pairs:
        """(long, short) where leaving out one symbol of the long word gives the short one.

        ``here``: the first one; ``not_here``: none that equals this at the first place.
        """
        found = self._delete(long, short, not_here)
        if here:
            return found
        return found + _solve(self._deleted, (long, short), self._both, self._delete_below)

    def below(self, long: int, short: int) -> Pairs:
        """The same without the first symbol of the long word."""
        return _solve(self._deleted, (long, short), self._both, self._delete_below)

    def after(self, a: int, b: int) -> Pairs:
        """Ranks below two states of the words that both accept."""
        return _solve(self._after, (a, b), self._both_but_equal, self._same_words)

    def _both(self, states: tuple[int, int]) -> list[tuple[int, int]]:
        mine, other = (self._v.arcs[s] for s in states)
        return [(mine[c][0], other[c][0]) for c in mine if c in other]

    def _both_but_equal(self, states: tuple[int, int]) -> list[tuple[int, int]]:
        return [] if states[0] == states[1] else self._both(states)

    def _same_words(self, states: tuple[int, int]) -> Pairs:
        a, b = states
        if a == b:
            return [(i, i) for i in range(self._v.count[a])]
        found = [(0, 0)] if self._v.final[a] and self._v.final[b] else []
        mine, other = self._v.arcs[a], self._v.arcs[b]
        for c, (to, before) in mine.items():
            if c in other:
                found += _moved(self._after[to, other[c][0]], before, other[c][1])
        return found

    def _replace(self, state: int) -> Pairs:
        arcs, found = list(self._v.arcs[state].values()), []
        for i, (to, before) in enumerate(arcs):
            for other, other_before in arcs[i + 1 :]:
                found += _moved(self.after(to, other), before, other_before)
        return found

    def _replace_next(self, state: int) -> list[int]:
        return [to for to, _ in self._v.arcs[state].values()]

    def _replace_below(self, state: int) -> Pairs:
        found = self._replace(state)
        for to, before in self._v.arcs[state].values():
            found += _moved(self._replaced[to], before, before)
        return found

    def _delete(self, long: int, short: int, last: str | None) -> Pairs:
        found = []
        for c, (to, before) in self._v.arcs[long].items():
            if c != last:
                found += _moved(self.after(to, short), before, 0)
        return found

    def _delete_below(self, states: tuple[int, int]) -> Pairs:
        mine, other, found = *(self._v.arcs[s] for s in states), []
        for c, (to, before) in mine.items():
            if c in other:
                to_short, before_short = other[c]
                pairs = self._delete(to, to_short, c) + self._deleted[to, to_short]
                found += _moved(pairs, before, before_short)
        return found


def _moved(pairs: Pairs, a: int, b: int) -> Pairs:
    return [(x + a, y + b) for x, y in pairs] if pairs else pairs


def _solve(known: dict, start: Hashable, needs: Callable, make: Callable) -> Pairs:
    """``make(start)`` after everything that it needs, without recursion: words may be long."""
    waiting = [start]
    while waiting:
        item = waiting[-1]
        missing = [] if item in known else [x for x in needs(item) if x not in known]
        if missing:
            waiting += missing
            continue
        waiting.pop()
        if item not in known:
            known[item] = make(item)
    return known[start]


# Rows below an initial state: which state (side, m, key, and for an edit here only, the hash
# of what follows it), what stands behind it, which role the word plays, the word and its n.
_STATES = (
    "side string, m int, key string, after long, depth int, rest string, role int, word string, n long"
)
_STATE_KEYS = ("side", "m", "key", "after")


def initial_states(words: DataFrame) -> DataFrame:
    """Every word behind each composed initial state that a pair of it can have in common.

    ``m`` is the length of the pair's shorter word and h half of it. The pair differs either
    behind its first h symbols (side ``f``) or before its last m - h (side ``b``, read from
    the end). A word is the shorter or of equal length for its own length, the longer for one
    less.
    """
    long = F.array(*(F.struct((F.char_length("word") - i).alias("m"), F.lit(i).alias("role")) for i in (0, 1)))
    sized = words.select("word", "n", F.explode(long).alias("part")).select("word", "n", "part.*")
    half = F.floor(F.col("m") / 2).cast("int")

    def side(name: str, text: Column, length: Column) -> Column:
        return F.struct(
            F.lit(name).alias("side"), F.substring(text, F.lit(1), length).alias("key"),
            F.substring(text, length + 1, F.char_length(text)).alias("rest"),
        )

    sides = F.array(
        side("f", F.col("word"), half), side("b", F.reverse("word"), F.col("m") - half)
    )
    return sized.where("m > 0").select("m", "role", "word", "n", F.explode(sides).alias("at")).select(
        "at.side", "m", "at.key", F.lit(-1).cast("long").alias("after"), F.lit(0).alias("depth"),
        "at.rest", "role", "word", "n",
    )


def _expanded(row: tuple) -> Iterator[tuple]:
    """The states that a row goes to when its own has too many words: one symbol further on,
    and, for an edit at this symbol, one state for each rest of the word behind it."""
    side, m, key, _, depth, rest, role, word, n = row
    behind = zlib.crc32(rest[1:].encode())
    if rest:
        yield side, m, key + rest[0], -1, depth + 1, rest[1:], role, word, n
        yield side, m, key, behind, depth, rest, role, word, n
    if role == _SHORT:
        yield side, m, key, zlib.crc32(rest.encode()), depth, rest, _TARGET, word, n


def _near_in_state(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, the largest n of these, the first of such words) below one state."""
    side, _, key, after, depth, *_ = rows[0]
    here = after >= 0
    roles: list[list[tuple]] = [[], [], []]
    for row in rows:
        roles[row[6]].append(row)
    for of in roles:
        of.sort(key=lambda row: row[5])
    v = Acceptor()
    roots = [v.root(row[5] for row in of) for of in roles]
    short, long, target = roles
    if not here:
        roots[_TARGET], target = roots[_SHORT], short
    pairs = OneEdit(v)
    found = [(short[a], short[b]) for a, b in pairs.replaced(roots[_SHORT], here)]
    if side == "b" and depth == 0:
        # Leaving out the symbol next to the shared half leaves the first h in common: side f.
        met = [] if here else pairs.below(roots[_LONG], roots[_TARGET])
    else:
        met = pairs.deleted(roots[_LONG], roots[_TARGET], here, key[-1] if depth else None)
    found += [(long[a], target[b]) for a, b in met]
    best: dict[str, list] = {}
    for one, other in found:
        for a, b in ((one, other), (other, one)):
            mine = best.setdefault(a[7], [0, (1, "")])
            mine[0] += 1
            mine[1] = min(mine[1], (-b[8], b[7]))
    for word, (count, (n, form)) in best.items():
        yield word, count, -n, form


def _composed(states: DataFrame, state_words: int) -> DataFrame:
    """Near words by state; rows of states with more than ``state_words`` come back expanded,
    with a null count."""
    names = ["near_word", "n_near", "best_n", "best", *(f.split()[0] for f in _STATES.split(", "))]
    nothing = (None,) * 9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(types)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        held: list[tuple] = []
        state, passing = None, False
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:4] != state:
                    if len(held) > 1:
                        out.extend((*near, *nothing) for near in _near_in_state(held))
                    held, state, passing = [], row[:4], False
                if passing:
                    out.extend((None,) * 4 + more for more in _expanded(row))
                else:
                    held.append(row)
                # A state for one rest holds at most a word for each symbol: it is not split.
                if len(held) > state_words and row[3] < 0:
                    out.extend((None,) * 4 + more for one in held for more in _expanded(one))
                    held, passing = [], True
                if len(out) >= 10_000:
                    yield flush()
        if len(held) > 1:
            out.extend((*near, *nothing) for near in _near_in_state(held))
        yield flush()

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(),
             pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64()]
    dealt = states.repartition(*_STATE_KEYS).sortWithinPartitions(*_STATE_KEYS)
    return dealt.mapInArrow(run, "near_word string, n_near long, best_n long, best string, " + _STATES)


def near_words(words: DataFrame, state_words: int = STATE_WORDS) -> DataFrame:
    """(word, n) of different words -> (word, n_near, best_n, best) for words with near ones.

    ``best`` is the near word of largest n, the first by code point among equals.
    """
    with temporaries(words.sparkSession):
        states, parts = initial_states(words), []
        while True:
            made = stage(_composed(states, state_words), "spelling-states")
            parts.append(made.where("near_word is not null").select("near_word", "n_near", "best_n", "best"))
            states = made.where("near_word is null").select(*(f.split()[0] for f in _STATES.split(", ")))
            if states.isEmpty():
                break
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
        merged = every.groupBy("near_word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
        merged = merged.select(
            F.col("near_word").alias("word"), "n_near", (-F.col("first.less")).alias("best_n"),
            F.col("first.word").alias("best"),
        )
        return stage(merged, "spelling-near", keep=True)


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the end of each word's chain of forms, by doubling."""
    with temporaries(forms.sparkSession):
        known = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
        for _ in range(DOUBLINGS):
            ahead = known.select(F.col("word").alias("at"), F.col("root").alias("next"))
            joined = known.join(ahead, F.col("root") == F.col("at"), "left")
            known = stage(
                joined.select("word", F.coalesce("next", "root").alias("root"),
                              F.col("next").isNotNull().alias("moved")),
                "spelling-roots", keep=True,
            )
            moved = not known.where("moved").isEmpty()
            known = known.drop("moved")
            if not moved:
                break
        return known


def spelling_variants(
    words: DataFrame, ratio: int = RATIO, state_words: int = STATE_WORDS
) -> DataFrame:
    """(word, n) -> (word, n, n_near, form, form_n, root), one row a word.

    ``form`` is the near word of largest n if that is at least ``ratio`` (2 or more) times the
    word's, else null; ``root`` is what following forms leads to. Rows of one word are added
    up; null and empty words and null counts are left out; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("the ratio must be 2 or more")
    clean = words.select(F.col("word").cast("string"), F.col("n").cast("long"))
    clean = clean.where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    clean = stage(clean, "spelling-words", keep=True)
    near = near_words(clean, state_words).withColumnRenamed("word", "near_word")
    good = F.col("best_n") >= F.lit(ratio) * F.col("n")
    found = clean.join(near, F.col("word") == F.col("near_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"),
    )
    found = stage(found, "spelling-forms", keep=True)
    ends = roots(found.where("form is not null").select("word", "form"))
    ends = ends.withColumnRenamed("word", "root_word")
    return found.join(ends, F.col("word") == F.col("root_word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
