"""Language by hierarchical discrimination: family first, then the language.

Linear support vector machines over hashed byte trigrams of lower-cased
letters, one for each pair of families and one for each pair of languages of a
family; the family with most votes is taken, then its language with most
votes, ties going to the larger sum of margins.  Closely related languages so
have machines of their own that need not tell anything else apart.

Learning: of the labelled documents at most about ``per_language`` of each
language, chosen by a hash of the doc_id, give their relative trigram
frequencies (whole texts) to the driver, 16 KB each: the bound of the fit is
per_language x languages vectors.  Families of learned languages are those of
``FAMILIES``; languages not listed there form the family ``other``.

Prediction reads each text once, without a shuffle; the weights are broadcast,
16 KB for each machine.

Defined results: a null text, or one without any letter, is ``und`` with score
0; so is every text when nothing was learned.  With one learned language every
text with a letter is in it.  Rows without a doc_id are predicted; they are no
part of the sample.  Columns other than those named are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_blocks, worker_cache
from .shingles import SEGMENT, mix, text_bytes

BITS = 12
PER_LANGUAGE = 250
UNDETERMINED = "und"

#: Language codes by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sh", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "sinitic": ("yue", "zh"),
}


def family(language: str) -> str:
    code = language.lower().split("-")[0].split("_")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), "other")


def trigrams(column):
    """(bucket of each trigram, where each text's begin and end)."""
    import numpy as np

    u = np.uint64
    byte = np.arange(256)
    upper = (byte >= 65) & (byte <= 90)
    kept = np.where(upper, byte + 32, np.where((byte >= 97) & (byte <= 122) | (byte >= 128), byte, 32)).astype(u)
    data, bounds = text_bytes(column)
    code, n = kept[data], max(0, len(data) - 2)
    bucket = mix((code[:n] << u(16) | code[1 : n + 1] << u(8) | code[2 : n + 2]) + u(1)) >> u(64 - BITS)
    return bucket.astype(np.int32), bounds[:-1], np.maximum(bounds[:-1], np.minimum(bounds[1:] - 2, n))


def _profiler():
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_blocks(batches, limit=SEGMENT):
            bucket, first, end = trigrams(batch.column("text"))
            rows = []
            for a, b in zip(first, end):
                counts = np.bincount(bucket[a:b], minlength=1 << BITS)
                rows.append((counts / max(1, b - a)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "profile": pa.array(rows, pa.binary())})

    return run


def fit_machine(x, y, rounds: int = 30, penalty: float = 1e-3):
    """(weights, bias) of a linear support vector machine: hinge loss and a
    quadratic penalty, by stochastic subgradients over shuffled rounds, averaged
    over the second half of them.  ``y`` is 1 or -1; both sides count alike."""
    import numpy as np

    rng = np.random.default_rng(0)
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, bias, step = np.zeros(x.shape[1]), 0.0, 0
    mean_w, mean_bias, taken = np.zeros(x.shape[1]), 0.0, 0
    for turn in range(rounds):
        for i in rng.permutation(len(y)):
            step += 1
            rate = 1 / (penalty * (step + 1000))
            inside = y[i] * (w @ x[i] + bias) < 1
            w *= 1 - rate * penalty
            if inside:
                w += rate * weight[i] * y[i] * x[i]
                bias += 0.01 * rate * weight[i] * y[i]
        if turn >= rounds // 2:
            mean_w, mean_bias, taken = mean_w + w, mean_bias + bias, taken + 1
    return mean_w / taken, mean_bias / taken


def fit(profiles: list[tuple[str, bytes]]) -> dict:
    """{"languages", "machines": [(one, other, weights, bias)]}; one and other
    are families or languages, all names sorted."""
    import numpy as np

    languages = sorted({lang for lang, _ in profiles})
    if not languages:
        return {"languages": [], "machines": []}
    labels = np.array([lang for lang, _ in profiles])
    x = np.stack([np.frombuffer(p, "<f4") for _, p in profiles]).astype(np.float64)
    scale = 1 / np.sqrt((x**2).mean(axis=0) + 1e-7)  # rare and common trigrams on a like footing
    scale /= np.sqrt(((x * scale) ** 2).sum(axis=1).mean()) + 1e-12  # vectors of about unit length
    x = x * scale
    families = sorted({family(lang) for lang in languages})
    of = np.array([family(lang) for lang in labels])
    jobs = [(a, b, of) for a, b in combinations(families, 2)]
    for name in families:
        jobs += [(a, b, labels) for a, b in combinations([lang for lang in languages if family(lang) == name], 2)]
    machines = []
    for a, b, names in jobs:
        chosen = (names == a) | (names == b)
        w, bias = fit_machine(x[chosen], np.where(names[chosen] == a, 1.0, -1.0))
        machines.append((a, b, (w * scale).astype(np.float32), float(bias)))
    return {"languages": languages, "machines": machines}


def _elected(names: list[str], margins: dict):
    """By text: (index of the elected name, confidence of that choice)."""
    import numpy as np

    n = len(next(iter(margins.values())))
    votes, sums, least = np.zeros((n, len(names))), np.zeros((n, len(names))), np.full((n, len(names)), np.inf)
    for (a, b), margin in margins.items():
        i, j = names.index(a), names.index(b)
        for k, m in ((i, margin), (j, -margin)):
            votes[:, k] += (m > 0) + 0.5 * (m == 0)
            sums[:, k] += m
            least[:, k] = np.minimum(least[:, k], m)
    won = np.lexsort((np.broadcast_to(-np.arange(len(names)), votes.shape), sums, votes))[:, -1]
    return won, 1 / (1 + np.exp(-2 * np.clip(least[np.arange(n), won], -30, 30)))


def _predictor(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("language")
        model = shared.value
        languages = model["languages"]
        families = sorted({family(lang) for lang in languages})
        for batch in text_blocks(batches, limit=SEGMENT):
            n = batch.num_rows
            bucket, first, end = trigrams(batch.column("text"))
            margins = {}
            for a, b, w, bias in model["machines"]:
                sums = np.append(0, np.cumsum(w[bucket], dtype=np.float64))
                margins[a, b] = (sums[end] - sums[first]) / np.maximum(1, end - first) + bias
            pick = lambda names: {k: v for k, v in margins.items() if k[0] in names and k[1] in names}
            lang, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
            won, sure = _elected(families, pick(families)) if len(families) > 1 else (np.zeros(n, int), np.ones(n))
            for f, name in enumerate(families):
                own = [x for x in languages if family(x) == name]
                best, sure_of_it = _elected(own, pick(own)) if len(own) > 1 else (np.zeros(n, int), np.ones(n))
                here = won == f
                lang[here] = np.array(own, dtype=object)[best[here]]
                score[here] = (sure * sure_of_it)[here]
            letter = np.array(batch.column("letter").to_pylist(), dtype=bool)
            lang[~letter], score[~letter] = UNDETERMINED, 0.0
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(lang.tolist(), pa.string()),
                    "score": pa.array(np.round(score, 6), pa.float64()),
                }
            )

    return run


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """A model of ``labelled`` (doc_id, text, lang; none null)."""
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one for each language
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    if not counts:
        return fit([])
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 1.5 * per_language / n))) for k, n in counts.items()], F.lit(0.0))
    some = labelled.filter(place < share).withColumn("place", place)
    chosen = some.select("doc_id", "lang", "place").withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id")))
    chosen = chosen.filter(F.col("n") <= per_language).select("doc_id").distinct()
    profiles = some.join(F.broadcast(chosen), "doc_id", "left_semi").mapInArrow(_profiler(), "lang string, profile binary")
    return fit(sorted((r["lang"], bytes(r["profile"])) for r in profiles.select("lang", "profile").collect()))


def predict(docs: DataFrame, held_out: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score.  Documents for which
    ``held_out`` is true take no part in learning."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    letter = F.coalesce("text", F.lit("")).rlike(r"\p{L}")
    labelled = docs.filter(~F.col("held_out") & letter & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    model = learn(labelled.select("doc_id", "text", "lang"), per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text", "held_out", (letter & F.lit(bool(model["languages"]))).alias("letter"))
    return rows.mapInArrow(_predictor(shared), "doc_id long, held_out boolean, lang_pred string, score double")
