"""Secret scan: high-recall candidates, then a random forest that removes false positives.

Candidates, the longer kind first where they overlap: the bodies of private key blocks; values that are assigned to a
credential's name, or stand as the password of a URL, whole, whatever they are made of; runs of token characters
with a digit or with the published prefix of a credential.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesnp import slices, text_column, word_bounds
from .scratch import free_name, small_batches

#: Shortest run of token characters, and shortest assigned value, that is a candidate.
SHORTEST, SHORTEST_VALUE = 8, 4
#: Bytes of context on each side from which neighbouring words are taken.
CONTEXT = 48
THRESHOLD = 0.5
MASK = "[SECRET]"

# Words of the dictionary, words that go with credentials, words that go with harmless numbers,
# marks of example paths, published prefixes of credentials.
DICTIONARY = (
    "about account address after again admin alpha amount api app auth back base beta block body book build call case change "
    "check class client close code color common config content copy count create data date day default delete demo detail "
    "document domain down download example fake field file first font form from function global group guest hash head "
    "header hello help here high home host html image index info input insert item java json key last layout left level "
    "library light line link list local login logo mail main make map master media member menu message method mobile model "
    "module month more name next node none note number object open option order other output page param parent part "
    "password path phone photo place placeholder play point port post price print private product profile public query "
    "read record release report request resource result right root sample save script search secret select server "
    "service session setting show sign simple size some sort source start state static status stop store string style "
    "system table template test text theme this time title token tool type update user value version view week width "
    "window with word work world write year your"
).split()
CREDENTIAL = "password passwd pwd pass passphrase passcode secret token apikey api_key key auth authorization bearer credential credentials access_key private login aws".split()
HARMLESS = "sha sha1 sha256 md5 commit checksum digest hash uuid guid id isbn phone tel call fax card order invoice version build revision serial etag integrity".split()
SAMPLE_PATH = "test tests example examples sample demo doc docs mock fixture fixtures spec template".split()
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "sk_live_", "rk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "glpat-", "SG.", "npm_")
FILLER = "example sample changeme placeholder dummy your xxxx 12345 abcd test fake todo none null undefined redacted hidden insert replace true false".split()

_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in string.ascii_letters + string.digits + "_+/-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PREFIXES = tuple(p.encode() for p in PREFIXES)
_KEY_MARK = re.compile(rb"-----(?:(BEGIN) (?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?|END [A-Z0-9 ]{1,40})-----")
#: The body of a key block without an end mark: its lines of key characters.
_KEY_LINES = re.compile(rb"(?:\s{0,4}[A-Za-z0-9+/=]{40,}+)+\s{0,4}[A-Za-z0-9+/=]*+")
#: Read on texts in lower case (the bytes' places stay). Texts without any of _NAMES have no such value.
_NAMES = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"credential", b"bearer", b"://")
_VALUE = re.compile(
    rb"(?:passw(?:or)?d|passphrase|passcode|pwd|pass|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth(?:orization)?|credentials?)"
    rb"[a-z0-9_.-]{0,40}+[\"'`\])]?[ \t]*+(?::=|=>|={1,2}|:)[ \t]*+(?:(?:bearer|basic|token)[ \t]++)?"
    rb"(?:\"([^\"\r\n]{1,4096}+)\"|'([^'\r\n]{1,4096}+)'|`([^`\r\n]{1,4096}+)`|[\"'`]?((?:[^\s\"'`&]|&(?![a-z_][a-z0-9_]{0,40}+=))+))"
    rb"|://[^\s:/@\"'<>]{1,80}+:([^\s@/\"'<>]{1,200}+)@|\bbearer[ \t]++([a-z0-9_.~+/-]{8,}+)"
)
#: What ends an unquoted value but isn't part of it.
_AFTER = b",;)]}>"
_PARTS = re.compile("|".join(sorted((w for w in DICTIONARY if len(w) > 3), key=len, reverse=True)))


def _transitions() -> np.ndarray:
    """Log probabilities of a character after another, from the dictionary's words."""
    counts = np.full((128, 128), 0.02)
    for w in DICTIONARY:
        for a, b in zip(f" {w}", f"{w} ", strict=True):
            counts[ord(a), ord(b)] += 1
    return np.log(counts / counts.sum(1, keepdims=True))


_LOG = _transitions()


_KIND = np.full(128, 3)
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 0, 1, 2
_HEX = np.zeros(128, bool)
_HEX[[ord(c) for c in string.hexdigits]] = True
_CODE = np.zeros(128, bool)
_CODE[[ord(c) for c in "()[]{}<>$%"]] = True
_BLOCK_MARK = re.compile(r"PRIVATE KEY(?: BLOCK)?-----\s*\Z")


def features(candidate: str, left: str, right: str, path: str | None) -> list[float]:
    """Length, kinds of characters and their transitions, dictionary coverage, neighbouring words and path of a candidate."""
    low = candidate.lower()
    codes = np.frombuffer(candidate.encode("ascii", "replace"), np.uint8)
    small = np.frombuffer(low.encode("ascii", "replace"), np.uint8)
    n, kinds = max(len(codes), 1), _KIND[codes]
    share = np.bincount(kinds, minlength=4) / n
    p = np.bincount(small, minlength=128) / max(len(small), 1)
    p = p[p > 0]
    before = [w.lower() for w in re.findall(r"[A-Za-z][A-Za-z0-9_]*", left)][-2:]
    after = [w.lower() for w in re.findall(r"[A-Za-z][A-Za-z0-9_]*", right)][:1]
    gap = re.search(r"[^A-Za-z0-9_]*\Z", left[-CONTEXT:]).group()
    covered = sum(map(len, _PARTS.findall(low)))
    words = {q for w in before for q in (w, *w.split("_"))}
    where = set(re.findall(r"[a-z]+", (path or "").lower()))
    quoted = gap[-1:] in ('"', "'", "`") and right[:1] == gap[-1:]
    return [
        n,
        *share.tolist(),
        float((kinds[1:] != kinds[:-1]).sum()) / n,
        float(_LOG[small[:-1], small[1:]].mean()) if len(small) > 1 else 0.0,
        float(-(p * np.log2(p)).sum()),
        covered / n,
        float(_HEX[codes].all()),
        float(candidate.startswith(PREFIXES)),
        float(any(w in low for w in FILLER)),
        float(bool(words & set(CREDENTIAL))),
        float(bool(words & set(HARMLESS)) or bool(set(after) & set(HARMLESS))),
        float("=" in gap or ":" in gap),
        float('"' in gap or "'" in gap or "`" in gap),
        float(bool(where & set(SAMPLE_PATH))),
        float(quoted),
        float(bool(_BLOCK_MARK.search(left))),
        float(_CODE[codes].sum()) / n,
        float(" " in candidate.strip()),
        len(p) / min(n, 64),
        float("." in candidate and not any(c.isdigit() for c in candidate)),
    ]


@dataclass
class Forest:
    """Trees as arrays: feature (-1: a leaf), threshold, left and right child, probability."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for feature, cut, left, right, p in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := np.flatnonzero(feature[at] >= 0)).size:
                k = at[inner]
                at[inner] = np.where(x[inner, feature[k]] <= cut[k], left[k], right[k])
            out += p[at]
        return out / len(self.trees)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 9, leaf: int = 3, seed: int = 7) -> Forest:
    """A forest by Gini splits: a bootstrap for each tree, sqrt(features) tried at each node."""
    rng = np.random.default_rng(seed)
    tries = max(1, round(x.shape[1] ** 0.5))
    out = []
    for _ in range(trees):
        nodes: list[list] = []

        def node(rows: np.ndarray, level: int) -> int:
            me, share = len(nodes), y[rows].mean()
            nodes.append([-1, 0.0, 0, 0, share])
            best = (share * (1 - share) * len(rows) - 1e-9, None, None)
            if level < depth and 0 < share < 1:
                for f in rng.choice(x.shape[1], tries, replace=False):
                    order = rows[np.argsort(x[rows, f], kind="stable")]
                    v, ones = x[order, f], np.cumsum(y[order])
                    n = np.arange(1, len(rows))
                    ok = (v[1:] > v[:-1]) & (n >= leaf) & (len(rows) - n >= leaf)
                    if not ok.any():
                        continue
                    a, b = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(rows) - n)
                    cost = np.where(ok, n * a * (1 - a) + (len(rows) - n) * b * (1 - b), np.inf)
                    k = int(cost.argmin())
                    if cost[k] < best[0]:
                        best = (cost[k], f, v[k])
            if best[1] is not None:
                small = x[rows, best[1]] <= best[2]
                nodes[me][:4] = [best[1], best[2], node(rows[small], level + 1), node(rows[~small], level + 1)]
            return me

        node(rng.integers(0, len(y), len(y)), 0)
        out.append(tuple(np.array(c, t) for c, t in zip(zip(*nodes), (np.int64, float, np.int64, np.int64, float))))
    return Forest(out)


def made_findings(n: int = 6000, seed: int = 11) -> list[tuple[str, str, str, str, int]]:
    """Labelled findings (candidate, left, right, path, label) by rule, for use where no reviewed ones are given.

    Secrets: keys with a published prefix, random strings, passwords and passphrases assigned to a credential's name, key
    blocks. Others: digests and ids beside the words that go with them, phone and card numbers, placeholders and code
    where a credential is expected, identifiers made of words, long numbers, prose after a colon.
    """
    r = random.Random(seed)
    some = lambda a, k: "".join(r.choice(a) for _ in range(k))
    hexa, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    syllables = [a + b for a in "bcdfghlmnprstvw" for b in ("a", "e", "i", "o", "an", "er", "ion", "th")]
    prose = lambda: " ".join(some(syllables, r.randint(1, 4)) for _ in range(6))
    word = lambda: r.choice([r.choice(DICTIONARY), some(syllables, r.randint(2, 3))])
    name = lambda: r.choice(["password", "passwd", "db_password", "secret", "token", "api_key", "auth_token", "access_key", "client_secret", "pwd", "pass", "DB_PASS", "SECRET_KEY", "admin.password"])
    paths = ["src3", "src0", "src12", "config/app.env", "deploy/run.sh", "web/index.js"]

    def assigned(before: str, value: str, quotes: float = 0.6) -> tuple[str, str, str]:
        """(value, left, right) with a credential's name and sign before it, mostly in quotes."""
        q = r.choice("\"'") if r.random() < quotes else ""
        sign = r.choice(["=", " = ", ": ", ":", " := ", " => "])
        return value, f"{before}{name()}{sign}{q}", q + r.choice([" ", "\n", ", ", ""])

    def password() -> str:
        kind = r.randrange(4)
        if kind == 0:  # words with digits and signs
            return "".join(r.choice([w, w.capitalize()]) for w in (word(), word())[: r.randint(1, 2)]) + some("0123456789", r.randint(0, 4)) + some("!@#$*&?.", r.randint(0, 2))
        if kind == 1:  # letters exchanged for digits and signs
            return "".join(dict(zip("aeiost", "@31057")).get(c, c) if r.random() < 0.6 else c for c in word() + word()) + some("!@#$%&0123456789", r.randint(1, 4))
        if kind == 2:
            return some(alnum + "!@#$%^&*-_+?.", r.randint(8, 20))
        return "".join(word() for _ in range(r.randint(2, 4)))

    def placeholder() -> str:
        return r.choice(
            ["changeme", "your_token", "your-password-here", "example", "password", "xxxxxxxx", "dummy", "<password>", "<your token>", "${DB_PASSWORD}", "$TOKEN", "{{ token }}", "%s", "%(password)s",
             "********", "....", "null", "None", "undefined", "true", "false", "os.environ[", "process.env.SECRET", "request.token", "self.password", "settings.SECRET_KEY", "getpass.getpass(",
             "get_token(user", "config.get(", "REDACTED", "[redacted]", "hidden", "insert here", "string", "String", "required", "optional", "test", "INSERT_KEY_HERE", "YOUR_API_KEY"]
        ) + (some(string.digits, r.randint(1, 3)) if r.random() < 0.2 else "")

    out = []
    while len(out) < n:
        left, right, path = prose() + " ", " " + prose(), r.choice(paths)
        kind = r.randrange(22)
        if kind == 0:
            c, y = r.choice(["AKIA", "ASIA"]) + some(string.ascii_uppercase + "234567", 16), 1
        elif kind == 1:
            c, y = r.choice(["ghp_", "sk_live_", "AIza", "npm_", "glpat-"]) + some(r.choice([alnum, string.ascii_letters]), r.randint(20, 40)), 1
        elif kind in (2, 3):
            (c, left, right), y = assigned(left, some(hexa, r.choice([12, 16, 18, 20, 32, 40, 64]))), 1
        elif kind in (4, 5):
            (c, left, right), y = assigned(left, some(alnum + "+/_-", r.randint(10, 44))), 1
        elif kind in (6, 7, 8):
            (c, left, right), y = assigned(left, password(), 0.75), 1
        elif kind == 9:
            (c, left, right), y = assigned(left, " ".join(word() for _ in range(r.randint(3, 6))), 1), 1
        elif kind == 10:
            c, left, right, y = password(), f"{left}postgres://{word()}:", f"@{word()}.example.com/db", 1
        elif kind == 11:
            mark = r.choice(["RSA ", "EC ", "OPENSSH ", ""]) + "PRIVATE KEY"
            body = "\n".join(some(alnum + "+/", 64) for _ in range(r.randint(1, 26))) + "\n" + some(alnum + "+/", r.randint(4, 60)) + r.choice(["", "=", "=="])
            c, y = "\n" + body + "\n", 1
            if r.random() < 0.3:
                c, y = r.choice(["\n...\n", "\n<key here>\n", "\nYOUR PRIVATE KEY\n", "\n" + prose() + "\n", " and ends with "]), 0
            left, right = f"{left}-----BEGIN {mark}-----", f"-----END {mark}-----"
        elif kind == 12:
            c, left, y = some(hexa, r.choice([7, 32, 40, 64]) + 1), left + r.choice(["commit ", "sha256 ", "sha1: ", "md5 = ", "checksum: ", "etag "]), 0
        elif kind == 13:
            c, left, y = some(string.digits, r.choice([10, 11, 13, 16, 16])), left + r.choice(["", "", "card ", "order ", "id=", "phone: "]), 0
        elif kind == 14:
            c, y = f"{some(string.digits, 3)}-{some(string.digits, 4)}", 0
        elif kind == 15:
            c, y = "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12)), 0
            left += r.choice(["id=", "uuid ", "request ", ""])
        elif kind in (16, 17):
            (c, left, right), y = assigned(left, placeholder()), 0
        elif kind == 18:  # prose after a colon or sign
            (c, left, right), y = assigned(left, word() + r.choice(["", "", ",", "."]), 0), 0
            right = " " + prose()
        elif kind == 19:
            c, y = "_".join(r.sample(DICTIONARY, r.randint(2, 4))) + some(string.digits, r.randint(1, 3)), 0
        elif kind == 20:
            c, y = some(syllables, r.randint(2, 5)) + some(string.digits, r.randint(1, 4)), 0
        else:
            c, y = r.choice(["AKIA" + some(string.ascii_uppercase, 9) + "EXAMPLE", r.choice(["eyJ", "SG.", "npm_"]) + some(syllables, 4) + " "]), 0
        if r.random() < 0.06:  # the same finding in a sample's folder is no leak
            path, y = r.choice(["tests/fixtures/a.txt", "docs/example.md"]), 0
        if len(c) >= SHORTEST_VALUE:
            out.append((c, left[-CONTEXT:], right[:CONTEXT], path, y))
    return out


def fit(findings: list[tuple[str, str, str, str, int]] | None = None) -> Forest:
    """A forest from labelled findings (candidate, left, right, path, label); by default made_findings()."""
    findings = made_findings() if findings is None else findings
    return grow(np.array([features(*f[:4]) for f in findings]), np.array([f[4] for f in findings], float))


def _key_blocks(raw: bytes) -> list[tuple[int, int]]:
    """Bodies of private key blocks: up to the next mark if it ends them, else the lines of key characters that follow."""
    out, marks = [], list(_KEY_MARK.finditer(raw))
    for m, after in zip(marks, [*marks[1:], None]):
        if not m[1]:
            continue
        if after is not None and not after[1]:
            span = m.end(), after.start()
        else:
            body = _KEY_LINES.match(raw, m.end())
            span = body.span() if body else (0, 0)
        if raw[span[0] : span[1]].strip():
            out.append(span)
    return out


def _values(raw: bytes) -> list[tuple[int, int]]:
    """Values of SHORTEST_VALUE bytes or more that are assigned to a credential's name or stand in a URL."""
    out, low = [], raw.lower()
    if not any(name in low for name in _NAMES):
        return out
    for m in _VALUE.finditer(low):
        s, e = m.span(m.lastindex)
        if m.lastindex == 4:
            while e > s and raw[e - 1] in _AFTER:
                e -= 1
            if raw[e - 1 : e] == b".":
                e -= 1
        if e - s >= SHORTEST_VALUE:
            out.append((s, e))
    return out


def candidates(column: pa.Array) -> list[list[tuple[int, int]]]:
    """For each text the (first byte, end byte) of its candidates, in order; none overlaps another."""
    offsets, whole = text_column(column)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(column))]
    for lo, hi in slices(offsets):
        data = whole[offsets[lo] : offsets[hi]]
        at = offsets[lo : hi + 1] - offsets[lo]
        runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        starts, ends, doc = word_bounds(data, at, _RUN)
        long = np.flatnonzero(ends - starts >= SHORTEST)
        starts, ends, doc = starts[long], ends[long], doc[long]
        raw = data.tobytes()
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        known = np.isin(data[starts], sorted({ord(p[0]) for p in PREFIXES} | set(b"+/-")))
        for k in np.flatnonzero((digits[ends] > digits[starts]) | known):
            s, e = int(starts[k]), int(ends[k])
            while s < e and data[s] in b"+/-":
                s += 1
            while e > s and data[e - 1] in b"+/-":
                e -= 1
            if e - s >= SHORTEST and (digits[e] > digits[s] or raw[s : s + 16].startswith(_PREFIXES)):
                runs[int(doc[k])].append((s - int(at[doc[k]]), e - int(at[doc[k]])))
        low = raw.lower()
        sign = any(name in low for name in _NAMES)
        for d in range(hi - lo) if sign or b"-----" in raw else runs:
            text = raw[at[d] : at[d + 1]]
            taken: list[tuple[int, int]] = []
            for kind in (_key_blocks(text) if b"-----" in text else [], _values(text) if sign else [], runs.get(d, [])):
                begins = [s for s, _ in taken]
                free = []
                for s, e in kind:
                    k = bisect_left(begins, e)
                    if not (k and taken[k - 1][1] > s) and not (free and free[-1][1] > s):
                        free.append((s, e))
                taken = sorted(taken + free)
            out[lo + d] = taken
    return out


_RESULT = "array<struct<start:bigint,end:bigint,finding:string,score:double>>"


def _found(column: pa.Array, paths: pa.Array, model: Forest) -> tuple[list[list[tuple[int, int]]], list[str], np.ndarray]:
    """(spans of each text, then in one row the candidates and their scores)."""
    spans = candidates(column)
    words, x = [], []
    for d, found in enumerate(spans):
        if not found:
            continue
        raw, where = column[d].as_py().encode("utf-8", "replace"), paths[d].as_py()
        for s, e in found:
            c, left, right = (b.decode("utf-8", "replace") for b in (raw[s:e], raw[max(0, s - CONTEXT) : s], raw[e : e + CONTEXT]))
            words.append(c)
            x.append(features(c, left, right, where))
    return spans, words, model.predict(np.array(x)) if x else np.zeros(0)


def _path(path: str | None):
    return F.col(path).cast("string") if path else F.lit(None).cast("string")


def findings_column(text: str, path: str | None, model):
    """Column of _RESULT for a text column and, if there is one, a path column; model: a broadcast Forest."""

    def scan(column: pa.Array, paths: pa.Array) -> pa.Array:
        spans, words, scores = _found(column, paths, model.value)
        flat = [s for row in spans for s in row]
        cols = [pa.array([s for s, _ in flat], pa.int64()), pa.array([e for _, e in flat], pa.int64()), pa.array(words, pa.string()), pa.array(scores)]
        values = pa.StructArray.from_arrays(cols, names=["start", "end", "finding", "score"])
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, spans))], pa.int32()), values)

    return arrow_udf(scan, _RESULT).asNondeterministic()(F.col(text), _path(path))


def masked_column(text: str, path: str | None, model, threshold: float, mask: str):
    """Column of the texts in which secrets are replaced; NULL where nothing changes."""

    def replace(column: pa.Array, paths: pa.Array) -> pa.Array:
        spans, _, scores = _found(column, paths, model.value)
        out, k = [], 0
        for d, found in enumerate(spans):
            hit = [s for j, s in enumerate(found) if scores[k + j] >= threshold]
            k += len(found)
            if not hit:
                out.append(None)
                continue
            raw, parts, last = column[d].as_py().encode("utf-8", "replace"), [], 0
            for s, e in hit:
                parts += [raw[last:s], mask.encode()]
                last = e
            out.append(b"".join([*parts, raw[last:]]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return arrow_udf(replace, "string").asNondeterministic()(F.col(text), _path(path))


def scan(docs: DataFrame, model: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """Documents -> (doc_id, start, end, finding, score, is_secret): a row for each candidate, by bytes of the UTF-8 text.

    Null and empty texts have none; very long ones are scanned whole. Repeated rows and rows with equal or null ids are
    scanned each for itself; other columns are not read. No rows: no rows.
    """
    small_batches(docs.sparkSession)
    found = findings_column(text_col, path_col, docs.sparkSession.sparkContext.broadcast(model))
    out = docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("f"))
    return out.select("doc_id", "f.*", (F.col("f.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: Forest, text_col: str = "text", path_col: str | None = "source", chars_col: str | None = "n_chars", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """docs with every secret replaced by `mask`, and chars_col counted anew where a text changes. Columns and rows as given.

    Null and empty texts stay as they are; repeated rows are masked each for itself. No rows: no rows.
    """
    small_batches(docs.sparkSession)
    masked = masked_column(text_col, path_col, docs.sparkSession.sparkContext.broadcast(model), threshold, mask)
    name = free_name(docs, "masked")
    out = docs.withColumn(name, masked)
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.col(name).isNull(), F.col(chars_col)).otherwise(F.length(name).cast(kind)))
    return out.withColumn(text_col, F.coalesce(name, text_col)).drop(name)
