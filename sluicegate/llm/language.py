"""Language identification by cross-parsing with suffix automata."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluicegate.functions.columns import named
from sluicegate.llm.common import column, to_batch, uniform, with_fields, with_text

UNKNOWN = "und"
#: Texts are parsed side by side in stretches of so many characters; a phrase ends with its stretch.
STRETCH = 1024
MAX_LANGUAGES = 1000
OTHER, GAP = 0, 1


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: Index of each letter; ``GAP`` stands for a run of anything else, ``OTHER`` for letters never learned.
    letters: dict[str, int]
    #: The arcs of all languages' automata, one behind another, as in ``Arcs``.
    slots: np.ndarray
    #: Per language, the state that its automaton starts in.
    roots: np.ndarray
    #: Per language, the bits that a phrase costs: the logarithm of the learned text's length.
    bits: np.ndarray

    def codes(self) -> np.ndarray:
        """Index of every code point: letters by their lower case, anything else as a gap."""
        table = getattr(self, "_codes", None)
        if table is None:
            table = np.full(0x110000, GAP, dtype=np.int32)
            for c in range(0x110000):
                if (x := chr(c)).isalpha():
                    table[c] = self.letters.get(x.lower(), OTHER)
            object.__setattr__(self, "_codes", table)
        return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Arcs:
    """Arcs by state and letter, whatever the number of letters, in room that grows with the arcs alone.

    The arc of a letter is in the slot ``state + letter``: the state that owns the slot in the upper 32
    bits, the next state in the lower ones. States are numbered so that no two arcs share a slot.
    """

    slots: np.ndarray

    def __getitem__(self, at: tuple[int, int]) -> int:
        """The next state, 0 where there is none; state 1 is the root."""
        found = int(self.slots[at[0] + at[1]])
        return found & LOW if found >> 32 == at[0] else 0


def _numbers(owner: np.ndarray, letter: np.ndarray, states: int) -> tuple[np.ndarray, int]:
    """A number for each state such that number and letter add up to a slot of its own for every arc, and their bound.

    ``owner`` is sorted. States draw at random until nothing is in their way, those with most arcs first. State 1
    stays 1.
    """
    rng = np.random.default_rng(0)
    size = np.bincount(owner, minlength=states)
    first = np.cumsum(size) - size
    reach = int(letter.max(initial=0)) + 1
    width = 3 * len(owner) + 64
    number = np.zeros(states, dtype=np.int64)
    number[1] = 1
    used, taken = np.zeros(width + reach, dtype=bool), np.zeros(width, dtype=bool)
    used[1 + letter[first[1] : first[1] + size[1]]] = True
    taken[:2] = True
    rank = np.frexp(size.astype(np.float64))[1]
    rank[:2] = -1
    for r in range(int(rank.max(initial=-1)), -1, -1):
        todo, failed = np.flatnonzero(rank == r), 0
        while len(todo):
            draw = rng.integers(2, width, len(todo))
            which = np.repeat(np.arange(len(todo)), size[todo])
            inside = np.arange(len(which)) - np.repeat(np.cumsum(size[todo]) - size[todo], size[todo])
            slot = draw[which] + letter[np.repeat(first[todo], size[todo]) + inside]
            free = ~taken[draw]
            free[which[used[slot]]] = False
            # Of those that meet in a slot or a number, the first has it.
            alone = np.zeros(len(todo), dtype=bool)
            alone[np.unique(draw, return_index=True)[1]] = True
            later = np.ones(len(slot), dtype=bool)
            later[np.unique(slot, return_index=True)[1]] = False
            alone[which[later]] = False
            free &= alone
            number[todo[free]] = draw[free]
            taken[draw[free]] = True
            used[slot[free[which]]] = True
            todo = todo[~free]
            failed = 0 if free.any() else failed + 1
            if failed == 16:
                used, taken = np.append(used, np.zeros(width, dtype=bool)), np.append(taken, np.zeros(width, dtype=bool))
                width, failed = 2 * width, 0
    return number, width + reach


def suffix_automaton(codes: list[int], letters: int) -> Arcs:
    """Arcs of the automaton of all substrings over so many letters; state 1 is the root and 0 means no arc."""
    arcs: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in codes:
        arcs.append({})
        length.append(length[last] + 1)
        link.append(1)
        new, p = len(arcs) - 1, last
        while p and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p:
            q = arcs[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                copy = len(arcs) - 1
                while p and arcs[p].get(c) == q:
                    arcs[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    owner = np.repeat(np.arange(len(arcs)), [len(out) for out in arcs])
    letter = np.array([c for out in arcs for c in out], dtype=np.int64)
    to = np.array([x for out in arcs for x in out.values()], dtype=np.int64)
    number, bound = _numbers(owner, letter, len(arcs))
    slots = np.zeros(bound + letters, dtype=np.int64)
    slots[number[owner] + letter] = number[owner] << 32 | number[to]
    return Arcs(slots)


def build_model(samples: dict[str, list[str]]) -> LanguageModel:
    """An automaton per language over its sampled passages, all with one alphabet of every letter in any of them."""
    seen = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
    index = {c: i + 2 for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])))}
    languages = tuple(sorted(samples))
    tables, sizes = [], []
    for language in languages:
        codes: list[int] = []
        for t in samples[language]:
            folded = [index[c] if c.isalpha() else GAP for c in t.lower()]
            folded = [c for i, c in enumerate(folded) if c != GAP or i == 0 or folded[i - 1] != GAP]
            codes += [*folded, GAP]
        tables.append(suffix_automaton(codes, len(index) + 2).slots)
        sizes.append(max(2, len(codes)))
    starts = np.cumsum([0, *(len(t) for t in tables)])
    # An automaton that starts at a slot has its states counted from there.
    slots = [np.where(t > 0, t + (start << 32 | start), 0) for t, start in zip(tables, starts[:-1].tolist())]
    joined = np.concatenate(slots) if slots else np.zeros(0, dtype=np.int64)
    return LanguageModel(languages, index, joined, starts[:-1] + 1, np.array([math.log2(n) for n in sizes]))


def phrase_counts(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per language and text when each is read as longest matches, and whether the text has a letter.

    Stretches of all texts advance together, one character a step. Runs of what is no letter count as
    one gap. A letter that a language has never seen is a phrase of its own.
    """
    languages = len(model.languages)
    table = model.codes()
    codes, has_letter = [], np.zeros(len(texts), dtype=bool)
    for i, text in enumerate(texts):
        c = table[_points(text)]
        has_letter[i] = bool((c != GAP).any())
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] != GAP) | (c[:-1] != GAP)
        codes.append(c[keep])
    owner, lanes = [], []
    for i, c in enumerate(codes):
        for s in range(0, len(c), STRETCH):
            owner.append(i)
            lanes.append(c[s : s + STRETCH])
    counts = np.zeros((languages, len(texts)))
    if not lanes or not languages:
        return counts, has_letter
    order = np.argsort([-len(x) for x in lanes], kind="stable")
    lengths = np.array([len(lanes[i]) for i in order])
    grid = np.zeros((lengths[0], len(order)), dtype=np.int32)
    for column_, i in enumerate(order):
        grid[: len(lanes[i]), column_] = lanes[i]
    root = model.roots[:, None]
    state = np.repeat(root, len(order), axis=1)
    phrases = np.ones((languages, len(order)), dtype=np.int32)
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    for step in range(lengths[0]):
        n = live[step]
        c = grid[step, :n]
        here = state[:, :n]
        found = model.slots.take(here + c)
        broken = found >> 32 != here
        again = model.slots.take(root + c)
        unknown = again >> 32 != root
        phrases[:, :n] += broken
        phrases[:, :n] += unknown
        again = np.where(unknown, root, again & LOW)
        state[:, :n] = np.where(broken, again, found & LOW)
    for lane, i in enumerate(order):
        counts[:, owner[i]] += phrases[:, lane]
    return counts, has_letter


def judge(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language of each text with the fewest bits, and by what share the next one needs more."""
    return _judge(model, texts)[:2]


def _judge(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """The same, and whether each text has a letter."""
    counts, has_letter = phrase_counts(model, [t or "" for t in texts])
    bits = counts * model.bits[:, None]
    names, scores = [], []
    for i in range(len(texts)):
        if not has_letter[i] or not model.languages:
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        ranked = np.argsort(bits[:, i], kind="stable")
        best = bits[ranked[0], i]
        names.append(model.languages[ranked[0]])
        scores.append(1.0 if len(ranked) == 1 else float(1 - best / bits[ranked[1], i]))
    return names, scores, has_letter.tolist()


def learn(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    key: str = "doc_id",
    train: Column | None = None,
    sample_docs: int = 256,
    passage: int = 256,
    passages: int = 64,
) -> LanguageModel:
    """A model from a bounded sample of the labelled rows. Every letter of the sample counts.

    Bounds, per language: ``sample_docs`` rows drawn by a hash of their key, of their texts' distinct
    passages of ``passage`` characters ``passages`` drawn by hash. Only these reach the driver. Rows
    whose text or language is NULL teach nothing; more than 1000 languages are refused.
    """
    rows = docs.where(F.lit(True) if train is None else train).select(
        column(key).alias("key"), column(text).alias("text"), column(language).alias("language")
    )
    rows = rows.where("text is not null and language is not null")
    counts = rows.groupBy("language").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return build_model({})
    share = F.create_map(*(F.lit(x) for r in counts for x in (r[0], 2.0 * sample_docs / r[1])))
    drawn = rows.withColumn("u", uniform(F.col("key"))).where(F.col("u") < share[F.col("language")])
    some = W.partitionBy("language").orderBy("u", "key")
    drawn = drawn.withColumn("place", F.row_number().over(some)).where(F.col("place") <= sample_docs)
    starts = F.sequence(F.lit(0), F.expr(f"(length(text) - 1) div {passage}"))
    cut = F.explode(F.transform(starts, lambda i: F.substring("text", i * passage + 1, F.lit(passage))))
    parts = drawn.where("text <> ''").select("language", cut.alias("part")).distinct()
    best = W.partitionBy("language").orderBy(F.xxhash64("part"), "part")
    parts = parts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= passages)
    samples: dict[str, list[str]] = {r[0]: [] for r in counts}
    for r in parts.orderBy("language", "place").collect():
        samples[r[0]].append(r[1])
    return build_model({k: v for k, v in samples.items() if v})


OUT = pa.schema([("lang_pred", pa.string()), ("lang_score", pa.float64()), ("has_letter", pa.bool_())])


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = (), letters: bool = False
) -> DataFrame:
    """The columns of ``keep``, then ``lang_pred`` and ``lang_score`` (0 to 1) of each row's whole text.

    ``und`` with score 0 where the text is NULL or has no letter, or where nothing was learned; with
    ``letters`` a further column ``has_letter`` tells the two apart. The
    model, whose size its sample bounds, is broadcast. Ties go to the name that sorts first.
    """
    rows, at = with_text(docs, text, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = "lang_pred string, lang_score double" + ", has_letter boolean" * letters
    schema = with_fields(rows.select(*named(*keep)).schema, fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            names, scores, lettered = [], [], []
            for part in _by_size(texts):
                found = _judge(model, part)
                names += found[0]
                scores += found[1]
                lettered += found[2]
            out = to_batch({"lang_pred": names, "lang_score": scores, "has_letter": lettered}, OUT)
            out = out.select(OUT.names if letters else OUT.names[:2])
            columns = [*batch.columns[: len(keep)], *out.columns]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *out.schema.names])

    return rows.mapInArrow(run, schema)


def _by_size(texts: list[str | None], characters: int = 4_000_000) -> Iterator[list[str | None]]:
    """Runs of texts of about so many characters, which bounds the memory of a parse."""
    part: list[str | None] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part
