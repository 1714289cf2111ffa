"""Personal data by weak supervision (operator 6).

Four base kinds are fixed patterns with checks. Beside them, looser candidates (national phone numbers, spelled-out
mail addresses, IPv6 addresses, card numbers with other separators or a wrong check digit, and, as a fifth kind, secrets:
values given to a name such as token or password) are judged by labelers that vote yes, no or nothing: the strict
format, a checksum (for secrets: as many different characters as chance gives), gazetteers (top-level domains, calling codes,
issuers' first digits, names of secrets), cue words before the span, and its surroundings. Expectation-maximisation over the counts of all vote patterns of all documents estimates how
reliable each labeler is; the resulting probabilities train a logistic span classifier on the votes and the span's
shape, and candidates it accepts are added to the base spans where they don't overlap.

What is gathered is a count for each (kind, votes, shape): at most a few thousand rows whatever the input.

Defined results: null and empty texts have no spans (the digest of an empty string); positions are code points,
ends exclusive; a null doc_id is passed on; repeated rows each get their row.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The base kinds, and the kind that only the method finds.
KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
BASE = 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IPV4 = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile("[0-9@]")

# The looser candidates.
LOOSE = (
    (EMAIL, re.compile(r"(?<!\S)[\w.+-]++ ?(?:\[at\]|\(at\)|\{at\}) ?[\w-]++(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?[\w-]{2,}+)++")),
    (IP, re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")),
    (CARD, re.compile(r"(?<![0-9.])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9.])")),
    (PHONE, re.compile(r"(?<![\w.+-])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /.-])[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![\w])")),
)
NAMED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)\s*+[=:]\s*+([\"']?)([^\s\"']{8,}+)(?:\2|(?=\s)|\Z)")
BRACKET = re.compile(r"[\[({]at[\])}]|[0-9]")

# Gazetteers and cue words (English, German, French, Spanish).
DOMAINS = frozenset("com org net edu gov io de fr es uk eu info biz".split())
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 61 81 86 90 91".split())
CUES = (
    frozenset("email mail e-mail contact write adresse correo courriel schreiben".split()),
    frozenset("ip host server address adresse dirección serveur".split()),
    frozenset("card visa mastercard amex credit karte kreditkarte carte tarjeta".split()),
    frozenset("tel phone call fax mobile cell telefon anrufen téléphone appel teléfono móvil llamar".split()),
    frozenset("secret token password login auth credentials passwort geheim clave secreto".split()),
)
SECRET_NAMES = frozenset("token secret password passwd pwd passphrase apikey key credential credentials auth bearer passwort contraseña clave jeton".split())
HEX_OR_64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
COUNTER_CUES = frozenset("order invoice version page isbn serial figure table price art artikel seite page página número no nr".split())
LABELERS = ("format", "checksum", "gazetteer", "context", "surroundings")
ACCEPT = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Leftmost matches: the run of local characters before each @, as far as no earlier match reaches."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted."""
    if not ANY.search(text):
        return []
    out = [(s, EMAIL, e) for s, e in emails(text)]
    out += [(m.start(), IP, m.end()) for m in IPV4.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), CARD, m.end()))
    if "+" in text:
        out += [(m.start(), PHONE, m.end()) for m in PLUS.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return sorted(out)


def free_of(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of the others and no earlier one of their own; both sorted."""
    out, at, reach = [], 0, 0
    for span in spans:
        while at < len(others) and others[at][0] < span[2]:
            reach = max(reach, others[at][2])
            at += 1
        if span[0] >= reach:
            out.append(span)
            reach = span[2]
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = []
    if BRACKET.search(text):
        found = [(m.start(), kind, m.end()) for kind, pattern in LOOSE for m in pattern.finditer(text)]
        found += [(m.start(), CARD, m.end()) for m in DIGITS.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(only_digits(m[0])) <= 19]
    if "=" in text or ":" in text:
        found += [(m.start(3), SECRET, m.end(3)) for m in NAMED.finditer(text) if name_parts(m[1]) & SECRET_NAMES]
    return free_of(sorted(found), base)


def name_parts(name: str) -> set[str]:
    return set(re.split(r"[_-]", name.lower()))


def votes(text: str, span: tuple[int, int, int]) -> str:
    """One letter a labeler: y, n or - (no vote)."""
    start, kind, end = span
    got, digits = text[start:end], only_digits(text[start:end])
    before = [w.strip(".,:;()").lower() for w in text[max(0, start - 60) : start].split()[-5:]]
    strict = (DOMAIN.search(got) is not None and "@" in got, IPV4.fullmatch(got) is not None, DIGITS.fullmatch(got) is not None, PLUS.fullmatch(got) is not None,
              HEX_OR_64.fullmatch(got) is not None)[kind]
    form = "y" if strict else "-"
    if kind == CARD:
        check = "y" if luhn(digits) else "n"
    elif kind == IP:
        check = "y" if ":" in got or all(int(p[:4]) <= 255 for p in got.split(".") if p) else "n"
    elif kind == PHONE:
        check = "y" if 9 <= len(digits) <= 15 else "n"
    elif kind == SECRET:  # written words repeat few letters; chance doesn't leave out many of a handful
        check = "y" if len(set(got)) >= min(10, len(got) // 2) and any(c.isdigit() for c in got) else "n"
    else:
        check = "-"
    if kind == EMAIL:
        known = "y" if re.split(r"[^\w]+", got.lower().rstrip(")]}"))[-1] in DOMAINS else "n"
    elif kind == PHONE and got[0] == "+":
        known = "y" if any(digits[:n] in CALLING for n in (1, 2)) else "n"
    elif kind == CARD:
        known = "y" if digits[0] in "3456" else "-"
    elif kind == SECRET:
        known = "y"  # it has the name of a secret
    else:
        known = "-"
    cue = "y" if CUES[kind].intersection(before) else "n" if COUNTER_CUES.intersection(before) else "-"
    left, right = text[start - 1 : start], text[end : end + 1]
    if kind == SECRET:
        return form + check + known + cue + ("y" if left in "\"'" and left and left == right else "-")
    around = "n" if left.isalnum() or right.isalnum() else "y" if (not left or left.isspace()) and (not right or right.isspace()) else "-"
    return form + check + known + cue + around


def shape(text: str, span: tuple[int, int, int]) -> str:
    """The span's shape in one letter each: its digits (in threes, up to 6) and whether it has separators."""
    got = text[span[0] : span[2]]
    n = len(only_digits(got))
    return f"{min(6, n // 3)}{int(n < len(got))}"


def _patterns(batches):
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column("_text"):
            text = text.as_py() or ""
            base = base_spans(text)
            for span in base:
                seen[KINDS[span[1]], votes(text, span), shape(text, span), True] += 1
            for span in loose_spans(text, base):
                seen[KINDS[span[1]], votes(text, span), shape(text, span), False] += 1
        keys = list(seen)
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([seen[k] for k in keys], pa.int64())], names=["kind", "votes", "shape", "base", "n"])


def reliabilities(patterns: list[tuple[str, float]], rounds: int = 100) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over vote patterns: the share of true spans, each labeler's (P(y | true), P(y | false)), and P(true | pattern)."""
    x = np.array([[1.0 if v == "y" else 0.0 if v == "n" else np.nan for v in p] for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    voted = ~np.isnan(x)
    yes = np.where(voted, x, 0.0)
    prior, rates = 0.5, np.tile([[0.8], [0.2]], (1, x.shape[1]))
    for _ in range(rounds):
        like = np.stack([np.where(voted, yes * np.log(r) + (1 - yes) * np.log(1 - r), 0).sum(1) for r in rates])
        odds = np.clip(like[0] - like[1] + np.log(prior / (1 - prior)), -30, 30)
        true = 1 / (1 + np.exp(-odds))
        weight = np.stack([true * n, (1 - true) * n])
        # two imaginary votes each way keep the rates off 0 and 1, and true spans on the side of the votes
        rates = np.stack([((w[:, None] * yes).sum(0) + a) / ((w[:, None] * voted).sum(0) + 4) for w, a in zip(weight, (3, 1), strict=True)])
        prior = (weight[0].sum() + 1) / (n.sum() + 2)
    return prior, rates, {p: float(t) for (p, _), t in zip(patterns, true, strict=True)}


def inputs(kind: str, vote: str, form: str) -> list[float]:
    """The classifier's features: an intercept for each kind, yes and no of each labeler, and the shape."""
    return ([float(kind == k) for k in KINDS] + [float(v == "y") - float(v == "n") for v in vote]
            + [float(form[0] == str(i)) for i in range(7)] + [float(form[1])])


def fit(rows: list[tuple[list[float], float, float]]) -> np.ndarray:
    """Logistic regression on (features, probability, count) with a ridge."""
    x, y, n = (np.array([r[i] for r in rows], float) for i in range(3))
    n = n / max(1.0, n.sum() / 1000)  # as a thousand spans: the ridge then means the same at every size
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta)), x.T @ (n * (y - p)) - 0.1 * beta)
        beta = beta + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame) -> np.ndarray | None:
    """The span classifier, from the vote patterns of all documents; None if there is no candidate."""
    found = (docs.select(F.col("text").cast("string").alias("_text"))
             .mapInArrow(_patterns, "kind string, votes string, shape string, base boolean, n long")
             .groupBy("kind", "votes", "shape", "base").agg(F.sum("n").alias("n")).collect())
    rows = []
    for kind in KINDS:
        own = sorted((r["votes"], r["shape"], r["base"], r["n"]) for r in found if r["kind"] == kind)
        if own:
            counts: Counter = Counter()
            for vote, _, _, n in own:
                counts[vote] += n
            _, _, true = reliabilities(sorted(counts.items()))
            rows += [(inputs(kind, vote, form), 1.0 if base else true[vote], n) for vote, form, base, n in own]
    return fit(rows) if rows else None


def all_spans(text: str, beta: np.ndarray | None) -> tuple[list, list]:
    """(base spans, all spans) as (start, kind, end), sorted."""
    base = base_spans(text)
    added = [] if beta is None else [s for s in loose_spans(text, base)
                                     if float(np.dot(inputs(KINDS[s[1]], votes(text, s), shape(text, s)), beta)) >= np.log(ACCEPT / (1 - ACCEPT))]
    return base, sorted(base + added) if added else base


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    model = spark.sparkContext.broadcast(train(docs))  # some twenty numbers

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("_text"):
                base, spans = all_spans(text.as_py() or "", model.value)
                kinds = [k for _, k, _ in base]
                rows.append([kinds.count(k) for k in range(BASE)] + [hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)])
            columns = [pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.string()) for i in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), *columns],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one's kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def without_personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with spans masked in text, and n_chars made to fit where a text changed. Other columns stay."""
    model = spark.sparkContext.broadcast(train(docs))
    names = docs.columns
    work = docs.select(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)])
    text_at, count_at = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            old = batch.column(count_at).to_pylist() if count_at >= 0 else [None] * batch.num_rows
            for text, n in zip(batch.column(text_at), old, strict=True):
                text = text.as_py()
                spans = all_spans(text, model.value)[1] if text else []
                new = masked(text, spans) if spans else text
                texts.append(new)
                counts.append(len(new) if spans else n)
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if count_at >= 0:
                columns[count_at] = pa.array(counts, columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return work.mapInArrow(run, work.schema).toDF(*names)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(spark, table(spark, sf_dir, "documents"))
