"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

The model is trained on trusted text (documents labelled as good) over symbols.
With ``whole`` (as in the registered queries) every character of the corpus is a
symbol, and one more is the start of a text; four symbols make an n-gram, so a
character of any script is weighed by the three before it.  N-grams of the 62 most
frequent characters, the narrow ones, have a bound whatever the corpus holds
(64^4), and so have what is collected of them and the tables that weigh them (67 MB
of float32 per fold and Python worker at most; a table has rows only for the
contexts seen).  All others, the wide ones, are weighed by joins.

Two smaller models have narrow n-grams only: without ``whole`` the characters that
are not among the 62 are one symbol, or, with ``spell``, each is written as that
symbol and its code point in digits of base 62 (two; from 62^2 on the symbol twice
and four), which tells characters apart but leaves them little or no context.

Training is a Spark job over all trusted documents: every task counts its own
n-grams, the sharded counts are summed by n-gram, and the orders are joined one
after another (n-gram with its context's totals and with its shorter n-gram's
probability) into interpolated probabilities and back-off weights.  Documents
are scored where they are, by looking their narrow n-grams up; these joins are over
distinct n-grams, and no text is shuffled to be scored.  A wide n-gram is sent once
per batch of documents, with the rows that hold it, to meet its probability; what
rows get back is summed in whole units of 2^-30 bits, so that the order does not
show.  All characters of every text count; one costs the bits of its symbols.

Documents fall into two folds by a hash of their id, and a document is weighed
by the model of the other fold.  So trusted documents, which set the limits, are
weighed like all others, by text that the model has not learned from.

A document is rejected if its bits per character lie further above the median of
trusted documents of its language and length (powers of two: short texts vary
more) than ``stretch`` times the distance of their ``quantile`` from it.  The
quantile is one that a hundred documents settle; the stretch leaves clean text in.
Where a language has fewer than ``least`` trusted documents of that length, the
limit is the language's median plus the same measure, over all languages, of
how far trusted documents of that length lie from their language's median; with
fewer than ``least`` of those, the highest of the limits of that cell, that
language and that length.  With no trusted document at all nothing is rejected.

Defined results: NULL or empty text has no perplexity and is kept.  A NULL
language is a language of its own.  NULL ids match no label.  An id is trusted
if all its labels say so; a document whose id repeats is trusted in every row.
An empty table gives no rows.  Other columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm import common as C
from panelcast.llm.registry import query

SYMBOLS = 64  # 0: start of text, 1..62: characters (and digits of others that are spelled), 63: any other
ORDER = 4
OTHER = SYMBOLS - 1
BASE = OTHER - 1
FOLDS = 2
#: Bits of a symbol in a context; three make a long.  With ``whole``, symbols from ``SYMBOLS`` on are code points.
FIELD = 21
#: Bits that only contexts with such a symbol have.
FAR = sum(((1 << FIELD) - SYMBOLS) << FIELD * k for k in range(ORDER - 1))
#: Of a bit, the unit in which the costs of wide n-grams are summed.
UNIT = 2.0**-30
#: Discounts are at least this, so that no symbol is impossible after any context of a small corpus.
LEAST_CUT = 0.1


def _code_points(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and the row offsets into them."""
    text = text.cast(pa.large_string()).fill_null("")
    points = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), "<u4")
    return points, np.concatenate([[0], np.cumsum(pc.utf8_length(text).to_numpy())])


def characters(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``c, n``: code points of all texts and how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for piece in C.slices(batch, text_col, 3_000_000):
                total += np.bincount(_code_points(piece.column(text_col))[0], minlength=0x110000)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["c", "n"])

    return df.select(text_col).mapInArrow(count, "c int, n long").groupBy("c").agg(F.sum("n").alias("n"))


def alphabet(seen: DataFrame) -> list[int]:
    """The most frequent of ``characters`` (ties to the smaller code point)."""
    return [r.c for r in seen.orderBy(F.desc("n"), "c").limit(OTHER - 1).collect()]


def _spelled(points: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Symbols of code points, and where each one's begin and the last one's end (None: one each)."""
    codes = table[points]
    rare = np.flatnonzero(codes == OTHER)
    if not len(rare):
        return codes, None
    point = points[rare].astype(np.int32)
    far = point >= BASE**2
    width = np.ones(len(points), np.int8)
    width[rare] = np.where(far, 6, 3)
    bounds = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    out = np.empty(bounds[-1], np.int32)
    out[bounds[:-1]] = codes  # of the others the escape
    ends, point_far = bounds[rare + 1], point[far]
    out[ends - 1] = point % BASE + 1
    out[ends - 2] = point // BASE % BASE + 1
    out[ends[far] - 3] = point_far // BASE**2 % BASE + 1
    out[ends[far] - 4] = point_far // BASE**3 + 1
    out[ends[far] - 5] = OTHER
    return out, bounds


def _grams(text: pa.Array, table: np.ndarray, spell: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One n-gram per symbol (starts padded) of all texts in a row, the row offsets, and the characters of each text."""
    points, rows = _code_points(text)
    chars = np.diff(rows)
    symbols, bounds = _spelled(points, table) if spell else (table[points], None)
    rows = rows if bounds is None else bounds[rows]
    pad = ORDER - 1
    codes = np.zeros(len(symbols) + pad * (len(rows) - 1), np.int32)
    at = np.arange(len(symbols)) + pad * (np.repeat(np.arange(len(rows) - 1), np.diff(rows)) + 1)
    codes[at] = symbols
    gram = codes[at]
    for back in range(1, ORDER):
        gram += codes[at - back] << np.int32(6 * back)
    return gram, rows, chars


def _whole_grams(text: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """One n-gram per character of all texts in a row: codes (of narrow ones), which are narrow, the others' (places, contexts, symbols), the row offsets."""
    points, rows = _code_points(text)
    pad = ORDER - 1
    codes = np.zeros(len(points) + pad * (len(rows) - 1), np.int32)
    at = np.arange(len(points)) + pad * (np.repeat(np.arange(len(rows) - 1), np.diff(rows)) + 1)
    codes[at] = table[points]
    gram, top = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
    for back in range(ORDER):
        symbol = codes[at - back]
        gram += (symbol & (SYMBOLS - 1)) << np.int32(6 * back)
        top |= symbol
    narrow = top < SYMBOLS
    far = np.flatnonzero(~narrow)
    context = np.zeros(len(far), np.int64)
    for back in range(1, ORDER):
        context |= codes[at[far] - back].astype(np.int64) << np.int64(FIELD * (back - 1))
    return gram, narrow, (far, context, codes[at[far]]), rows


def _symbol_table(letters: list[int], whole: bool = False) -> np.ndarray:
    table = np.arange(SYMBOLS, SYMBOLS + 0x110000, dtype=np.int32) if whole else np.full(0x110000, OTHER, np.int32)
    table[letters] = np.arange(1, len(letters) + 1)
    return table


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of integer columns, an order that sorts the rows, and where each distinct one begins in it."""
    order = np.lexsort(columns[::-1])
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    starts = np.flatnonzero(first)
    return [c[order[starts]] for c in columns], order, starts


def _fold(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(FOLDS)).cast("int")


_COUNTS = "f int, x long, y int, n long"


def gram_counts(trusted: DataFrame, letters: list[int], spell: bool = False, whole: bool = False) -> DataFrame:
    """``f, x, y, n``: how often symbol ``y`` follows the longest context ``x`` in the trusted texts (``f, text``) of a fold."""

    def rows(fold: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        kinds = (np.int32, np.int64, np.int32, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c.astype(kind)) for c, kind in zip((fold, x, y, n), kinds)], names=["f", "x", "y", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbol_table(letters, whole)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for piece in C.slices(batch, "text", 3_000_000):
                if whole:
                    gram, narrow, (far, x, y), ends = _whole_grams(piece.column("text"), table)
                else:
                    gram, ends, _ = _grams(piece.column("text"), table, spell)
                    narrow, far = slice(None), ()
                fold = np.repeat(piece.column("f").to_numpy(), np.diff(ends)).astype(np.int64)
                if len(far):  # of these there is no bound, so they are not held
                    found, _, starts = _distinct(fold[far], x, y)
                    yield rows(*found, np.diff(np.append(starts, len(far))))
                k, n = np.unique((fold * SYMBOLS**ORDER + gram)[narrow], return_counts=True)
                keys, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n]).astype(np.float64), len(keys)).astype(np.int64)
        fold, gram = np.divmod(keys, SYMBOLS**ORDER)
        x = sum(((gram >> 6 * back) & (SYMBOLS - 1)) << FIELD * (back - 1) for back in range(1, ORDER))
        yield rows(fold, x, gram % SYMBOLS, counts)

    return trusted.select("f", "text").mapInArrow(count, _COUNTS).groupBy("f", "x", "y").agg(F.sum("n").alias("n"))


def _last(x: Column, symbols: int) -> Column:
    """The last symbols of a context."""
    return x.bitwiseAND(F.lit((1 << FIELD * symbols) - 1).cast("long"))


def kneser_ney(counts: DataFrame, symbols: int = SYMBOLS) -> list[tuple[DataFrame, DataFrame]]:
    """Per order, from 1: ``f, x, y, p``, the probability of each n-gram seen, and ``f, x, w``, the back-off weight of each context."""
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        # Continuation counts: how many symbols come before the shorter n-gram.
        orders[k] = orders[k + 1].groupBy("f", _last(F.col("x"), k - 1).alias("x"), "y").agg(F.count(F.lit(1)).alias("n"))
    out: list = []
    for k in range(1, ORDER + 1):
        c = C.stored(orders[k])
        # Modified discounts for counts of 1, 2 and 3 or more, from the counts of counts of this order.
        cuts = []
        for r in c.groupBy("f").agg(*[F.count_if(F.col("n") == j).alias(f"n{j}") for j in (1, 2, 3, 4)]).collect():
            n = [float(r[f"n{j}"]) for j in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
            cuts += [(r.f, j, max(LEAST_CUT, j - (j + 1) * y * n[j] / n[j - 1]) if n[j - 1] else LEAST_CUT) for j in (1, 2, 3)]
        table = c.sparkSession.createDataFrame(cuts, "f int, j long, d double")
        seen = c.withColumn("j", F.least("n", F.lit(3).cast("long"))).join(table, ["f", "j"])
        totals = seen.groupBy("f", "x").agg(F.sum("n").alias("t"), F.sum("d").alias("e"))
        totals = totals.select("f", "x", "t", (F.col("e") / F.col("t")).alias("w"))
        joined = seen.join(totals, ["f", "x"])
        if not out:
            below = F.lit(1.0 / symbols)
        else:
            joined = joined.withColumn("s", _last(F.col("x"), k - 2))
            joined = joined.join(out[-1][0].select("f", F.col("x").alias("s"), "y", F.col("p").alias("q")), ["f", "s", "y"])
            below = F.col("q")
        p = ((F.col("n") - F.col("d")) / F.col("t") + F.col("w") * below).alias("p")
        out.append((C.stored(joined.select("f", "x", "y", p)), totals.select("f", "x", "w")))
    return out


def _narrow(orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``ord, f, g, p, w`` of narrow n-grams and contexts, in codes of six bits a symbol."""
    near = (F.col("x").bitwiseAND(F.lit(FAR).cast("long")) == 0) & (F.col("y") < SYMBOLS)
    field = lambda k: F.shiftright(F.col("x"), FIELD * k).bitwiseAND(F.lit(SYMBOLS - 1).cast("long")) * SYMBOLS**k
    code = sum((field(k) for k in range(1, ORDER - 1)), field(0))
    none = F.lit(None).cast("double")
    model = None
    for k, (grams, contexts) in enumerate(orders, 1):
        seen = grams.filter(near).select(F.lit(k).alias("ord"), "f", (code * SYMBOLS + F.col("y")).alias("g"), "p", none.alias("w"))
        weights = contexts.withColumn("y", F.lit(0)).filter(near).select(F.lit(k).alias("ord"), "f", code.alias("g"), none.alias("p"), "w")
        model = seen.unionByName(weights) if model is None else model.unionByName(seen).unionByName(weights)
    return model


def probabilities(grams: DataFrame, orders: list[tuple[DataFrame, DataFrame]], symbols: int) -> DataFrame:
    """``f, x, y, p`` of the distinct n-grams ``f, x, y``, seen or not."""
    needed = {ORDER: C.stored(grams.select("f", "x", "y").distinct())}
    for k in range(ORDER - 1, 0, -1):
        needed[k] = needed[k + 1].select("f", _last(F.col("x"), k - 1).alias("x"), "y").distinct()
    lower = None
    for k, (seen, weights) in enumerate(orders, 1):
        found = needed[k].join(seen, ["f", "x", "y"], "left").join(weights, ["f", "x"], "left")
        below = F.lit(1.0 / symbols)
        if lower is not None:
            found = found.withColumn("s", _last(F.col("x"), k - 2))
            found = found.join(lower.select("f", F.col("x").alias("s"), "y", F.col("p").alias("q")), ["f", "s", "y"])
            below = F.col("q")
        # Of contexts never seen all weight goes to the shorter one.
        lower = C.stored(found.select("f", "x", "y", F.coalesce("p", F.coalesce("w", F.lit(1.0)) * below).alias("p")))
    return lower


def _lower_orders(parts: dict, symbols: int = SYMBOLS) -> np.ndarray:
    """Probability of every possible n-gram of the orders below the highest."""
    p = np.full(1, 1.0 / symbols, np.float32)
    for k in range(1, ORDER):
        (g, seen), (x, w) = parts[k]
        back = np.ones(SYMBOLS ** (k - 1), np.float32)  # of contexts never seen: all weight to the shorter one
        back[x] = w
        wide = np.broadcast_to(p.reshape(-1, SYMBOLS) if k > 1 else np.broadcast_to(p, (1, SYMBOLS)), (1 if k == 1 else SYMBOLS ** (k - 2), SYMBOLS))
        p = (back.reshape(-1, wide.shape[0], 1) * wide[None]).reshape(-1)
        p[g] = seen
    return p


class Costs:
    """Negative log2 probability of every possible n-gram, from the seen ones and the back-off weights.

    Only contexts that were seen have a row of their own; all others share the row
    of their shorter context, so a table is as large as what the model has learned.
    """

    def __init__(self, parts: dict, symbols: int = SYMBOLS):
        lower = _lower_orders(parts, symbols).reshape(-1, SYMBOLS)
        (g, seen), (x, w) = parts[ORDER]
        own = np.unique(np.concatenate([x, g // SYMBOLS]))
        self.row = (np.arange(SYMBOLS ** (ORDER - 1)) % len(lower)).astype(np.int32)
        self.row[own] = len(lower) + np.arange(len(own), dtype=np.int32)
        back = np.ones(len(own), np.float32)
        back[np.searchsorted(own, x)] = w
        p = np.concatenate([lower, back[:, None] * lower[own % len(lower)]]).reshape(-1)
        p[self.row[g // SYMBOLS] * SYMBOLS + g % SYMBOLS] = seen
        np.log2(p, out=p)
        self.cost = np.negative(p, out=p)

    def of(self, grams: np.ndarray) -> np.ndarray:
        return self.cost[self.row[grams >> 6] * SYMBOLS + (grams & (SYMBOLS - 1))]


class Model:
    """Scores texts; made by ``fit``."""

    def __init__(self, spark, letters: list[int], orders: list[tuple[DataFrame, DataFrame]], symbols: int = SYMBOLS, spell: bool = False):
        parts: list = []
        rows = _narrow(orders).toArrow()  # at most FOLDS * (64^4 n-grams and 64^3 contexts), see above
        order, fold, g = (rows.column(c).to_numpy() for c in ("ord", "f", "g"))
        p, w = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("p", "w"))
        for f in range(FOLDS):
            own: dict = {}
            for k in range(1, ORDER + 1):
                a, b = (fold == f) & (order == k) & ~np.isnan(p), (fold == f) & (order == k) & ~np.isnan(w)
                own[k] = ((g[a], p[a].astype(np.float32)), (g[b], w[b].astype(np.float32)))
            parts.append(own)
        shared = spark.sparkContext.broadcast((letters, parts))
        name = uuid.uuid4().hex

        @F.arrow_udf("double")
        def bits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            known, tables = shared.value
            # Once a worker, not once a task.
            symbols, costs = C.held(("quality", name), lambda: (_symbol_table(known), [Costs(t) for t in tables]))
            for text, fold in batches:
                out = []
                for piece in C.slices(pa.RecordBatch.from_arrays([text, fold], names=["t", "f"]), "t", 1_500_000):
                    gram, rows, n = _grams(piece.column("t"), symbols, spell)
                    own = piece.column("f").to_numpy()
                    # A text is weighed by what the other folds taught.
                    which = np.repeat((own + 1) % FOLDS, np.diff(rows))
                    cost = np.zeros(len(gram), np.float32)
                    for f in range(FOLDS):
                        at = which == f
                        cost[at] = costs[f].of(gram[at])
                    total = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
                    mean = (total[rows[1:]] - total[rows[:-1]]) / np.maximum(n, 1)
                    out.append(pa.array(mean, mask=n == 0))
                yield pa.concat_arrays(out) if out else pa.array([], pa.float64())

        self.bits = bits

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, tables = shared.value
            table, costs = C.held(("quality", name), lambda: (_symbol_table(known, True), [Costs(t, symbols) for t in tables]))
            for batch in batches:
                for piece in C.slices(batch, "text", 1_500_000):
                    gram, narrow, (far, x, y), rows = _whole_grams(piece.column("text"), table)
                    which = np.repeat((piece.column("f").to_numpy() + 1) % FOLDS, np.diff(rows))
                    cost = np.zeros(len(gram), np.float32)
                    for f in range(FOLDS):
                        at = narrow & (which == f)
                        cost[at] = costs[f].of(gram[at])
                    total = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
                    cut = np.searchsorted(far, rows)
                    pack = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())  # noqa: E731, B023
                    kept = [piece.column(c) for c in piece.schema.names if c != "text"]
                    near = pa.array(total[rows[1:]] - total[rows[:-1]])
                    yield pa.RecordBatch.from_arrays([*kept, near, pa.array(np.diff(rows)), pack(x), pack(y)], names=[*(c for c in piece.schema.names if c != "text"), "near", "n", "x", "y"])

        self._look, self._orders, self._symbols = look, orders, symbols

    def weighed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``f``, a fold, and ``text``) with ``bits`` for ``f`` and ``text``, every character a symbol of its own."""
        kept = [c for c in rows.columns if c not in ("f", "text")]
        plain = rows.drop("text").schema
        schema = T.StructType([*plain, *T._parse_datatype_string("near double, n long, x binary, y binary")])
        looked = C.stored(rows.select(*plain.names, "text").mapInArrow(self._look, schema).withColumn("row", F.monotonically_increasing_id()))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in (("x", np.int64), ("y", np.int32)))
                times = pc.binary_length(batch.column("y")).to_numpy() // 4
                f, row = (np.repeat(batch.column(c).to_numpy(), times) for c in ("f", "row"))
                found, order, starts = _distinct((f + 1) % FOLDS, x, y)
                own, ends = row[order], [*starts[1:].tolist(), len(order)]
                held = pa.array([own[a:b].tobytes() for a, b in zip(starts.tolist(), ends)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in found), held], names=["f", "x", "y", "rows"])

        def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row = np.frombuffer(b"".join(batch.column("rows").to_pylist()), np.int64)
                cost = np.repeat(batch.column("cost").to_numpy(), pc.binary_length(batch.column("rows")).to_numpy() // 8)
                found, order, starts = _distinct(row)
                sums = np.add.reduceat(cost[order], starts) if len(row) else cost
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(sums)], names=["row", "cost"])

        grams = looked.filter(F.octet_length("x") > 0).select("f", "row", "x", "y").mapInArrow(send, "f int, x long, y int, rows binary")
        p = probabilities(grams, self._orders, self._symbols)
        costs = p.select("f", "x", "y", F.round(-F.log2("p") / UNIT).cast("long").alias("cost"))
        far = C.stored(grams.join(costs, ["f", "x", "y"]).select("rows", "cost").mapInArrow(give, "row long, cost long").groupBy("row").agg(F.sum("cost").alias("far")))
        bits = (F.col("near") + F.coalesce("far", F.lit(0)) * UNIT) / F.col("n")
        out = C.stored(looked.join(far, "row", "left").select(*kept, F.when(F.col("n") > 0, bits).alias("bits")))
        for table in (looked, far):
            C.discard(table)
        return out

    def cross_entropy(self, text: Column, id_: Column) -> Column:
        """Mean bits per character of a text; NULL without characters."""
        return self.bits(text, _fold(id_))


def _band(text: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)))).cast("int")


class Classifier:
    """A trained model with its thresholds."""

    def __init__(self, model: Model, limits: DataFrame, id_col: str, text_col: str, lang_col: str, scores: DataFrame | None = None):
        self.model, self.limits, self.id_col, self.text_col, self.lang_col = model, limits, id_col, text_col, lang_col
        #: With ``whole``, ``id, lang, band, k1, k2, bits`` of the rows that the model was fitted for.
        self.scores = scores

    def own(self) -> DataFrame:
        """Those rows with ``__bits`` and ``__limit`` (both may be NULL)."""
        limits = self.limits.select(F.col("lang").alias("__lang"), F.col("band").alias("__b"), F.col("limit").alias("__limit"))
        on = F.col("__lang").eqNullSafe(F.col("lang")) & (F.col("__b") == F.col("band"))
        return self.scores.withColumnRenamed("bits", "__bits").join(limits, on, "left")

    def scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__bits`` and ``__limit`` (both may be NULL)."""
        limits = self.limits.select(F.col("lang").alias("__lang"), F.col("band").alias("__b"), F.col("limit").alias("__limit"))
        marked = df.withColumns({"__bits": self.model.cross_entropy(F.col(self.text_col), F.col(self.id_col)), "__band": _band(F.col(self.text_col))})
        # The limits are complete: one row per language and length in the table they were made for.
        on = F.col("__lang").eqNullSafe(F.col(self.lang_col)) & (F.col("__b") == F.col("__band"))
        return marked.join(limits, on, "left").drop("__lang", "__b", "__band")

    @staticmethod
    def good() -> Column:
        """Whether a scored row is kept."""
        return F.coalesce(F.col("__bits") <= F.col("__limit"), F.lit(True))


def _row_key(id_: Column, text: Column, lang: Column) -> list[Column]:
    """128 bits that name what a row is weighed by."""
    parts = [id_, id_.isNull(), text, text.isNull(), lang, lang.isNull()]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = 0.98,
    stretch: float = 1.7,
    least: int = 100,
    spell: bool = False,
    whole: bool = False,
) -> Classifier:
    """Trains on the documents that ``labels`` (``id_col, quality``) trust, and sets the limits for ``docs``.

    With ``whole`` every character is a symbol of its own; ``spell`` only tells rare
    characters apart (see above); without both they count as one symbol.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    trust = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1").select("id")
    seen = characters(slim)
    seen = C.stored(seen) if whole else seen
    letters = alphabet(seen)
    symbols = seen.count() + 1 if whole else SYMBOLS
    # A shuffle join at every size: labels grow with the corpus, so no plan rests on their being few.
    trusted = slim.join(trust.hint("merge"), "id", "left_semi").select(_fold(F.col("id")).alias("f"), "text")
    counts = C.stored(gram_counts(trusted, letters, spell, whole))
    model = Model(spark, letters, kneser_ney(counts, symbols), symbols, spell)
    own = slim.select("id", "lang", _band(F.col("text")).alias("band"), *([] if not whole else _row_key(F.col("id"), F.col("text"), F.col("lang"))), "text")
    if whole:
        scores = model.weighed(own.withColumn("f", _fold(F.col("id"))))
    else:
        scores = C.stored(own.withColumn("bits", model.cross_entropy(F.col("text"), F.col("id"))).drop("text"))
    same = lambda a, b: F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang"))
    good = scores.filter("bits is not null").join(trust, "id", "left_semi")
    middle = good.groupBy("lang").agg(F.percentile_approx("bits", 0.5, 100_000).alias("m"))
    good = C.stored(
        good.alias("s").join(middle.alias("m"), same("s", "m")).select("s.lang", "s.band", "s.bits", (F.col("s.bits") - F.col("m.m")).alias("off"))
    )

    def at(x: str) -> Column:
        both = F.percentile_approx(x, [0.5, quantile], 100_000)
        return both[0] + F.lit(stretch) * (both[1] - both[0])

    own = good.groupBy("lang", "band").agg(at("bits").alias("own"), F.count(F.lit(1)).alias("n"))
    by_lang = good.groupBy("lang").agg(at("bits").alias("l"))
    by_band = good.groupBy("band").agg(at("off").alias("o"), at("bits").alias("b"), F.count(F.lit(1)).alias("n"))
    cells = scores.select("lang", "band").distinct()
    pooled = F.when(F.col("h.n") >= least, F.coalesce(F.col("m.m") + F.col("h.o"), F.col("h.b")))
    widest = F.greatest("o.own", "g.l", "h.b")
    limits = C.stored(
        cells.alias("c")
        .join(own.alias("o"), same("c", "o") & (F.col("c.band") == F.col("o.band")), "left")
        .join(by_lang.alias("g"), same("c", "g"), "left")
        .join(middle.alias("m"), same("c", "m"), "left")
        .join(by_band.alias("h"), F.col("c.band") == F.col("h.band"), "left")
        .select("c.lang", "c.band", F.when(F.col("o.n") >= least, F.col("o.own")).otherwise(F.coalesce(pooled, widest)).alias("limit"))
    )
    return Classifier(model, limits, id_col, text_col, lang_col, scores if whole else None)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, language, ``perplexity``, ``threshold``, ``keep``."""
    made = fit(docs, labels, id_col, **options)
    lang = made.lang_col
    if made.scores is None:
        out = made.scored(docs.select(id_col, lang, made.text_col))
    else:
        out = made.own().select(F.col("id").alias(id_col), F.col("lang").cast(docs.schema[lang].dataType).alias(lang), "__bits", "__limit")
    return out.select(id_col, lang, F.pow(F.lit(2.0), "__bits").alias("perplexity"), F.pow(F.lit(2.0), "__limit").alias("threshold"), made.good().alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    made = fit(docs, labels, **options)
    # The rows' own columns go by position, so that no name of theirs meets one of ours.
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    plain = Classifier(made.model, made.limits, at[made.id_col], at[made.text_col], at[made.lang_col])
    if made.scores is not None:
        keyed = docs.toDF(*at.values()).withColumns({f"k{k}": c for k, c in enumerate(_row_key(F.col(at[made.id_col]), F.col(at[made.text_col]), F.col(at[made.lang_col]).cast("string")), 1)})
        bad = made.own().filter(~made.good()).select("k1", "k2").distinct()
        return keyed.join(bad, ["k1", "k2"], "left_anti").select(*at.values()).toDF(*at)
    # Stored, since then workers get rows in small batches beside the model.
    return C.stored(plain.scored(docs.toDF(*at.values())).filter(plain.good()).select(*at.values())).toDF(*at)


def labels_of(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    return classify(C.documents(spark, sf_dir), labels_of(spark, sf_dir), whole=True)
