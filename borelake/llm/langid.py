"""Language identification by hierarchical discrimination.

A text first gets its language family, then its language among those of that family:

1. A text is its letters, lower-cased, with one space for every run of anything else. Its features are
   the square roots of the shares of its hashed one- to four-letter grams, a vector of length one.
2. Families are told apart by a linear support vector machine each (one against the rest). Within a
   family, every two languages have one of their own (one-versus-one); each pair gives its winner a
   vote, and equal votes are settled by the sum of margins.
3. Each machine is one group of the bounded sample and fitted by dual coordinate descent in a task of
   its own. The weights, ``2**BITS`` floats a machine, are broadcast.

``FAMILIES`` is a parameter; a language that it lacks is a family of its own.

Defined results: a null text, or one without letters, is ``und`` with score 0, as is every text where
nothing could be learned; equal texts get equal languages; repeated rows and ids, and null ids (never
held out, never learned), give a row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import park
from ..functions.coerce import quoted
from .common import bounded_rows, by_slice, fold

BITS, GRAMS = 15, 4
# Rows and bytes of text learned from, over all languages, and languages learned, at most.
SAMPLE_DOCS, SAMPLE_BYTES, MOST_LANGS = 4_000, 16 << 20, 128
COST, EPOCHS = 10.0, 30
FOLDS, HELD = 4, 2
UNKNOWN = "und"
# Code points looked at together; grams across the seam are kept.
_WINDOW = 1 << 20

# Closely related languages.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi ur bn pa gu mr ne si",
    "malayic": "id ms tl jv",
}

_OTHER = re.compile(r"[\W\d_]+")
_ODD = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]
_SHIFT = np.uint32(32 - BITS)


def family_of(lang: str, families: Mapping[str, str] = FAMILIES) -> str:
    """The family of a language code, by its part before a hyphen; an unlisted code is its own."""
    code = lang.lower().split("-")[0].split("_")[0]
    return next((name for name, codes in families.items() if code in codes.split()), lang)


def counts(text: str) -> np.ndarray | None:
    """How often each hashed gram occurs in the whole text; None where it has no letter."""
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not letters:
        return None
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(codes), _WINDOW):
        part = codes[at : at + _WINDOW + GRAMS - 1]
        gram = np.zeros(len(part), np.uint32)
        for size in range(GRAMS):
            fresh = part[size:] * _ODD[size]
            gram = (gram[: len(fresh)] ^ fresh) * _ODD[0] + np.uint32(size)
            mine = gram[: min(len(gram), _WINDOW)]
            found += np.bincount((mine ^ mine >> np.uint32(15)) * _ODD[1] >> _SHIFT, minlength=1 << BITS)
    return found


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Numbers and values of the features of a text, a vector of length one."""
    found = counts(text)
    if found is None:
        return None
    at = np.flatnonzero(found)
    return at.astype(np.uint16), np.sqrt(found[at] / found.sum()).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the last one the bias, of a linear machine with squared hinge loss (dual coordinate descent)."""
    weights = np.zeros((1 << BITS) + 1)
    damp = 1 / (2 * cost)
    curve = [float(x @ x) + 1 + damp for _, x in rows]
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            slope = signs[i] * (x @ weights[at] + weights[-1]) - 1 + damp * alpha[i]
            fresh = max(alpha[i] - slope / curve[i], 0.0)
            step = (fresh - alpha[i]) * signs[i]
            if step:
                alpha[i] = fresh
                weights[at] += step * x
                weights[-1] += step
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights


class Model:
    """The machines of all families, and of each pair of languages within one."""

    def __init__(self, machines: Mapping[tuple[str, str], np.ndarray], members: Mapping[str, list[str]]):
        """``machines``: (family, "") or (language, language) to weights; ``members``: by family."""
        self.members = {f: sorted(langs) for f, langs in members.items()}
        self.families = sorted(members)
        self.tops = self._stack([machines[f, ""] for f in self.families]) if len(self.families) > 1 else None
        self.pairs = {f: list(combinations(langs, 2)) for f, langs in self.members.items()}
        self.weights = {f: self._stack([machines[p] for p in pairs]) for f, pairs in self.pairs.items() if pairs}

    @staticmethod
    def _stack(weights: list[np.ndarray]) -> np.ndarray:
        return np.array(weights, np.float32)

    @staticmethod
    def _margins(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        return weights[:, :-1] @ x + weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a text and how sure that is, 0 to 1."""
        found = counts(text) if text and self.families else None
        if found is None:
            return UNKNOWN, 0.0
        x = np.sqrt(found / found.sum()).astype(np.float32)
        family, sure = self.families[0], 1.0
        if self.tops is not None:
            margins = self._margins(self.tops, x)
            best = int(np.argmax(margins))
            others = float(np.delete(margins, best).max())
            family, sure = self.families[best], _sure(float(margins[best]) - others)
        langs = self.members[family]
        if len(langs) == 1:
            return langs[0], sure
        votes, sums = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for (a, b), margin in zip(self.pairs[family], self._margins(self.weights[family], x).tolist(), strict=True):
            votes[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        winner = max(langs, key=lambda lang: (votes[lang], sums[lang]))
        return winner, sure * _sure(2 * sums[winner] / (len(langs) - 1))


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -35, 35))))


def train(docs: DataFrame, families: Mapping[str, str] = FAMILIES) -> Model:
    """A model of ``doc_id, text, lang`` rows with an id and a language, outside the held fold."""
    usable = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD))
    usable = usable.where(F.col("text").rlike(r"\p{L}"))
    known = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()
    langs = sorted(r["lang"] for r in known)
    if not langs:
        return Model({}, {})
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(family_of(lang, families), []).append(lang)
    some = bounded_rows(
        usable.where(F.col("lang").isin(langs)), SAMPLE_DOCS // len(langs), SAMPLE_BYTES // len(langs), within="lang"
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = batch.column(0).to_pylist()
            found = [(lang, *f, text) for lang, text in zip(batch.column(1).to_pylist(), whole, strict=True) if (f := features(text))]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, *_ in found], pa.string()),
                 pa.array([xxhash.xxh64_intdigest(text) >> 1 for *_, text in found], pa.int64()),
                 pa.array([at.tobytes() for _, at, *_ in found], pa.binary()),
                 pa.array([x.tobytes() for _, _, x, _ in found], pa.binary())],
                names=["lang", "place", "at", "x"],
            )

        return work

    sample = park(
        by_slice(some.select("text", "lang"), make, "lang string, place bigint, at binary, x binary"), "language-sample"
    )
    # Each machine gets the rows of its problem, with the side they are on.
    sides: dict[str, list[tuple[str, str, int]]] = {lang: [] for lang in langs}
    for family, inside in members.items():
        if len(members) > 1:
            for lang in langs:
                sides[lang].append((family, "", 1 if lang in inside else -1))
        for a, b in combinations(sorted(inside), 2):
            sides[a].append((a, b, 1))
            sides[b].append((a, b, -1))
    table = docs.sparkSession.createDataFrame(
        [(lang, *side) for lang, each in sides.items() for side in each], "lang string, one string, other string, side int"
    )

    def machine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending"), ("side", "ascending")])
        signs = rows.column("side").to_numpy().astype(np.float64)
        # Views of the received bytes, so that a machine costs no more than its sample.
        found = zip(*(rows.column(c).combine_chunks() for c in ("at", "x")), strict=True)
        each = [(np.frombuffer(at.as_buffer(), np.uint16), np.frombuffer(x.as_buffer(), np.float32)) for at, x in found]
        weights = fit(each, signs).astype(np.float32)
        return pa.table({
            "one": rows.column("one")[:1], "other": rows.column("other")[:1], "weights": pa.array([weights.tobytes()], pa.binary())
        })

    fitted = sample.join(F.broadcast(table), "lang").groupBy("one", "other").applyInArrow(
        machine, "one string, other string, weights binary"
    ).collect()
    return Model({(r["one"], r["other"]): np.frombuffer(r["weights"], np.float32) for r in fitted}, members)


def predict(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    families: Mapping[str, str] = FAMILIES,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, by a model of the rows not held out."""
    docs = df.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), quoted(lang_col).alias("lang"))
    model = df.sparkSession.sparkContext.broadcast(train(docs, families))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def make():
        tell = model.value.predict

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [tell(text) for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([lang for lang, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

        return work

    return by_slice(docs.select("doc_id", "text"), make, f"doc_id {id_type}, lang_pred string, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
