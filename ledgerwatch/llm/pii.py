"""Personal data by weak supervision (operator 9), on DataFrame functions only.

Base spans (email, ip, card, phone) follow fixed patterns and checks. For other
strings a wide net takes candidates (secrets: long runs of letters and digits;
phones without a plus sign), and labelers vote on each: patterns, gazetteers,
context words before it, and shape. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is; its posteriors train a
logistic span classifier on the candidate's own features, which decides which
candidates become spans. Vote and feature patterns are a bounded set, so the
counts of all candidates of the corpus fit in a small table.

Offsets are code points. A pattern's spans come from its matches and the pieces
between them, so a text is scanned, never cut up.

Defined results: a null text is empty; repeated rows get the same spans; an
added span never overlaps a base span or an earlier added one; without any
candidate the classifier accepts nothing; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import table

# The patterns below match as the plain ones of the contract do. Lookbehinds and
# possessive loops only keep long runs of one class from being tried at each of
# their characters: a failed run fails from its later characters too.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

SECRET = r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{12,}+"
LOCAL_PHONE = r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
ADDED = ("secret", "local_phone")

#: Letters and lengths that key formats of well-known services have (gazetteer).
KEY_PREFIXES = r"^(AKIA|ASIA|AIza|ghp|gho|glpat|xox[abp]|sk|pk|rk|SG|EAAC)"
SECRET_WORDS = r"(?i)(password|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key|bearer|credential|login)[^A-Za-z0-9]*$"
PHONE_WORDS = r"(?i)(tel|phone|call|fax|mobile|cell|ring|dial)[^A-Za-z0-9]*$"
OTHER_WORDS = r"(?i)(isbn|issn|doi|version|ver|sha1|sha256|md5|commit|checksum|page|figure|table|http|www|id)[^A-Za-z0-9]*$"
#: Area codes of toll-free and fictitious numbers (gazetteer).
PUBLIC_CODES = r"^[(]?(800|888|877|866|855|844|833|900|555)"
CONTEXT = 24


def _spans(pattern: str, keep) -> Column:
    """Array of (start, end) of the pattern's matches that ``keep`` accepts."""
    found, rest = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)
    pairs = F.arrays_zip(F.transform(rest, F.length).alias("gap"), found.alias("hit"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        good = x["hit"].isNotNull() & keep(x["hit"])
        return F.struct(end.alias("at"), F.when(good, F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"))))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(pairs, empty, step, lambda acc: acc["out"])


def _luhn(hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), step) % 10 == 0).otherwise(False)


def _octets(hit: Column) -> Column:
    # By length first: a run of digits may be longer than any number type.
    return F.forall(F.split(hit, r"\."), lambda p: F.when(F.length(F.regexp_replace(p, "^0+", "")) > 3, False)
                    .otherwise(F.coalesce(F.right(p, F.lit(9)).cast("int") <= 255, F.lit(False))))


def _gated(gate: Column, pattern: str, keep) -> Column:
    """Most texts lack a needed character; they aren't scanned for the pattern."""
    return F.when(gate, _spans(pattern, keep)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def base_spans(documents: DataFrame) -> DataFrame:
    """documents with text (null: empty) and an array column, __ and its name, for each base kind."""
    digits = F.regexp_replace
    return (documents.withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("__email", _gated(F.contains("text", F.lit("@")), EMAIL, lambda h: F.lit(True)))
            .withColumn("__ip", _gated(F.col("text").rlike(r"[0-9]\.[0-9]"), IP, _octets))
            .withColumn("__card", _gated(F.col("text").rlike(r"[0-9](?:[\x20-]?+[0-9]){12}"), CARD, _luhn))
            .withColumn("__phone", _gated(F.contains("text", F.lit("+")), PHONE,
                                        lambda h: F.length(digits(h, "[^0-9]", "")).between(9, 15))))


def _chars(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def _candidates(rows: DataFrame) -> DataFrame:
    """Adds ``__candidates``: (kind, start, end, votes, features) of the wide net, without
    those that overlap a base span."""
    text = F.col("text")
    gate = text.rlike("[0-9]")
    net = rows.withColumn("__secret", _gated(gate, SECRET, lambda h: F.lit(True)))
    net = net.withColumn("__local_phone", _gated(gate, LOCAL_PHONE, lambda h: F.lit(True)))
    base = F.concat(*[F.col(f"__{k}") for k in KINDS])

    def free(s: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    def vote(yes: Column, no: Column | None = None) -> Column:
        out = F.when(yes, "+")
        return (out if no is None else out.when(no, "-")).otherwise("0")

    def described(kind: str):
        def one(s: Column) -> Column:
            hit = _chars(text, s["start"], s["end"])
            at = F.greatest(s["start"] - CONTEXT, F.lit(0))
            before = _chars(text, at, s["start"])
            prior, after = F.right(before, F.lit(1)), _chars(text, s["end"], s["end"] + 1)
            digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
            if kind == "secret":
                votes = [vote(hit.rlike(r"^([A-Z]{4}[A-Z0-9]{16}|[0-9a-f]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), hit.rlike("^[A-Z]?[a-z]+[0-9]{1,4}$")),
                         vote(hit.rlike(KEY_PREFIXES)),
                         vote(before.rlike(SECRET_WORDS), before.rlike(OTHER_WORDS)),
                         vote((digits >= 4) & (F.length(F.regexp_replace(hit, "([A-Za-z0-9])(?=.*\\1)", "")) >= 8), digits <= 2)]
            else:
                votes = [vote(hit.rlike(r"^([(][2-9][0-9]{2}[)]\x20?|[2-9][0-9]{2}[\x20.-])[2-9]"), hit.rlike("^[(]?[01]")),
                         vote(F.lit(False), hit.rlike(PUBLIC_CODES)),
                         vote(before.rlike(PHONE_WORDS), before.rlike(OTHER_WORDS)),
                         vote(hit.rlike(r"[(]|(-[0-9]{3}-)"), hit.rlike(r"^[0-9]{3}\x20[0-9]{3}\x20"))]
            size = F.length(hit)
            features = [F.when(hit.rlike("[A-Z]"), "U").otherwise("u"), F.when(hit.rlike("[a-z]"), "L").otherwise("l"),
                        F.when(hit.rlike("[g-zG-Z]"), "x").otherwise("h"),
                        F.when(digits * 4 < size, "d0").when(digits * 2 < size, "d1").when(digits < size, "d2").otherwise("d3"),
                        F.when(size < 16, "n0").when(size < 20, "n1").when(size < 32, "n2").when(size < 64, "n3").otherwise("n4"),
                        F.when(prior.isin("=", '"', "'", ":"), "p=").when(prior == "(", "p(").otherwise("p_"),
                        F.when(after.isin('"', "'"), 'a"').otherwise("a_")]
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                            F.concat(*votes).alias("votes"), F.array(*[F.concat(F.lit(f"{i}:"), f) for i, f in enumerate(features)]).alias("features"))
        return one

    found = F.concat(*[F.transform(F.filter(F.col(f"__{k}"), free), described(k)) for k in ADDED])
    return net.withColumn("__candidates", found).drop(*[f"__{k}" for k in ADDED])


def reliabilities(counts: dict[tuple[str, str], int], steps: int = 100) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """Expectation-maximisation over vote patterns (Dawid-Skene with two classes).

    counts: (kind, votes) -> candidates. Returns labeler -> accuracy where it
    votes (named kind/number), and (kind, votes) -> probability of personal data.
    """
    accuracy: dict[str, float] = {}
    posterior: dict[tuple[str, str], float] = {}
    for kind in sorted({k for k, _ in counts}):
        own = {v: n for (k, v), n in counts.items() if k == kind}
        width = len(next(iter(own)))
        # Rates of each vote given the class, smoothed; the start trusts every labeler alike.
        rate = [{c: {v: 0.6 if v == s else 0.15 if v in "+-" else 0.25 for v in "+-0"} for c, s in ((1, "+"), (0, "-"))} for _ in range(width)]
        prior, post = 0.5, {}
        for _ in range(steps):
            post = {}
            for votes in own:
                p = {c: math.log(prior if c else 1 - prior) + sum(math.log(rate[i][c][v]) for i, v in enumerate(votes)) for c in (0, 1)}
                post[votes] = 1 / (1 + math.exp(max(-50.0, min(50.0, p[0] - p[1]))))
            total = sum(own.values())
            prior = min(0.99, max(0.01, (1 + sum(n * post[v] for v, n in own.items())) / (2 + total)))
            for i in range(width):
                for c in (0, 1):
                    mass = defaultdict(float)
                    for votes, n in own.items():
                        mass[votes[i]] += n * (post[votes] if c else 1 - post[votes])
                    # Pseudo-counts keep the meaning of a vote: a plus speaks for the class.
                    add = {"+": 3.0 if c else 1.0, "-": 1.0 if c else 3.0, "0": 2.0}
                    whole = sum(mass.values()) + sum(add.values())
                    rate[i][c] = {v: (mass[v] + add[v]) / whole for v in "+-0"}
        for i in range(width):
            right = prior * rate[i][1]["+"] + (1 - prior) * rate[i][0]["-"]
            wrong = prior * rate[i][1]["-"] + (1 - prior) * rate[i][0]["+"]
            accuracy[f"{kind}/{i}"] = right / (right + wrong)
        posterior |= {(kind, v): p for v, p in post.items()}
    return accuracy, posterior


def classifier(rows: list[tuple[str, list[str], float, float]], steps: int = 300) -> dict[str, dict[str, float]]:
    """Logistic regression per kind on feature patterns: (kind, features, positives,
    candidates). Returns kind -> feature -> weight; '' is the constant."""
    out: dict[str, dict[str, float]] = {}
    for kind in sorted({r[0] for r in rows}):
        own = [(["", *f], y, n) for k, f, y, n in rows if k == kind]
        total = sum(n for _, _, n in own)
        w: dict[str, float] = defaultdict(float)
        moment: dict[str, float] = defaultdict(float)
        for _ in range(steps):  # adaptive gradient steps on the mean loss, with a ridge
            slope = {f: 1e-3 * v for f, v in w.items()}
            for fs, y, n in own:
                z = max(-30.0, min(30.0, sum(w[f] for f in fs)))
                e = (n / (1 + math.exp(-z)) - y) / total
                for f in fs:
                    slope[f] = slope.get(f, 0.0) + e
            for f, s in slope.items():
                moment[f] += s * s
                w[f] -= 0.5 * s / (math.sqrt(moment[f]) + 1e-9)
        out[kind] = dict(w)
    return out


def fit(rows: DataFrame) -> tuple[dict[str, dict[str, float]], dict[str, float]]:
    """The span classifier and the labelers' reliabilities, from all candidates of ``rows``."""
    one = rows.select(F.explode("__candidates").alias("c")).select("c.kind", "c.votes", "c.features")
    patterns = one.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")).collect()  # a bounded set of patterns
    counts: dict[tuple[str, str], int] = defaultdict(int)
    for r in patterns:
        counts[r.kind, r.votes] += r.n
    accuracy, posterior = reliabilities(dict(counts))
    soft: dict[tuple[str, tuple[str, ...]], list[float]] = defaultdict(lambda: [0.0, 0.0])
    for r in patterns:
        cell = soft[r.kind, tuple(r.features)]
        cell[0] += posterior[r.kind, r.votes] * r.n
        cell[1] += r.n
    return classifier([(k, list(f), y, n) for (k, f), (y, n) in sorted(soft.items())]), accuracy


def _accepted(weights: dict[str, dict[str, float]]) -> Column:
    """The candidates with a positive score, those that overlap an earlier one left out."""
    def total(c: Column, w: dict[str, float]) -> Column:
        known = F.create_map(*[x for f, v in sorted(w.items()) if f for x in (F.lit(f), F.lit(float(v)))])
        return F.aggregate(c["features"], F.lit(float(w[""])), lambda acc, f: acc + F.coalesce(F.element_at(known, f), F.lit(0.0)))

    def score(c: Column) -> Column:
        out = F.lit(-1.0)
        for kind, w in weights.items():
            out = F.when(c["kind"] == kind, total(c, w)).otherwise(out)
        return out

    good = F.filter("__candidates", lambda c: score(c) > 0)
    short = F.transform(good, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return F.aggregate(F.array_sort(short), none, lambda acc, c: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > c["start"]), acc).otherwise(F.array_append(acc, c)))


def spans(documents: DataFrame, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """documents with text made non-null, an array column per base kind (__email and so on),
    and ``__added``: (start, end, kind) of the method's own spans."""
    rows = _candidates(base_spans(documents))
    if weights is None:
        weights = fit(rows)[0]
    return rows.withColumn("__added", _accepted(weights)).drop("__candidates")


def _joined(kind: str) -> Column:
    return F.transform(f"__{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _of_kind(kind: str) -> Column:
    return F.filter("__added", lambda s: s["kind"] == kind)


def _marked(kind: str) -> Column:
    return F.transform(f"__{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def op9_pii_weak_supervision(spark, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.concat(*[_joined(k) for k in KINDS])
    added = [F.transform(_of_kind(k), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
             for k in ADDED]
    return found.select("doc_id", *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, *added), ",").alias("spans"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span replaced by its kind in brackets, and n_chars made to fit."""
    # The caller's columns travel in one struct, so no name of theirs meets one of the operator's.
    found = spans(docs.select(F.struct("*").alias("doc"), "text"))
    every = F.array_sort(F.concat(*[_marked(k) for k in KINDS], F.col("__added")))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        fresh = F.concat(acc["out"], _chars(text, acc["at"], s["start"]), label)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    masked = F.aggregate(every, start, step, lambda acc: F.concat(acc["out"], _chars(text, acc["at"], F.length(text))))
    out = found.withColumn("text", F.when(F.size(every) > 0, masked).otherwise(text))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[fresh.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
