"""Secret scans with SQL expressions alone, and a random forest that removes false findings.

A candidate is a value of at least 6 characters, of a word of at least 12 with a digit, of a word with a key such as
``password=``, or of one of the three words after a word that names a secret: each value with its key in JSON, connection strings and lists, the password of an address, and each run between quotes, brackets
and separators; and a block of a private key is one candidate, whose words are no others.  Its features: length; how often the character class changes and how common its letter pairs are (character transitions);
shares of digits, capitals and distinct characters; how much of it dictionary words cover; known issuers' beginnings;
shapes of numbers, hashes and identifiers; words of secrecy and of harmlessness in its key, among the three words
before and the two after; and the path it comes from.

The forest is trained on labelled findings: texts that hold one finding each, with label 1 for a secret.  Without a
table of one's own :func:`labelled_findings` makes one from rules.  Features of the training texts come from the same
expressions as those of documents.  Training is on the driver from at most ``MOST_FINDINGS`` rows; the forest is then
one SQL expression, so a scan is a projection: no shuffle, no Python on executors, and a row's findings stay in the row.

A finding's place is that of its word, a block's that of its first word.

Defined cases: null and empty texts have no findings; a value found twice in a text is two findings; with labels of one
class only every score is that class; a missing path is empty; repeated rows each give their findings; extra columns
are ignored by :func:`findings` and kept by :func:`redact`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled findings that the forest is trained on, at most.
MOST_FINDINGS = 6000
TREES, DEPTH, LEAST_LEAF = 25, 6, 4
_KEYS = "pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|(?:access|account|shared)[_-]?key|auth|bearer|credential|private"
_HARMLESS = "example|sample|dummy|placeholder|commit|revision|sha\\d*|md5|checksum|digest|hash|uuid|guid|version|isbn|phone|card|order|invoice|ticket|build|etag"
_PREFIXES = "(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[baprs]-|sk_live_|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{30,}|glpat-|eyJ[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]*PRIVATE KEY-----"
_PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea"
_DICTIONARY = (
    "password secret token example sample test dummy change default admin user login name value string number index table column version "
    "release build image file path data base server client config local host public private service account access manager report "
    "document page item order product model summer winter spring monday january hello world welcome dragon master placeholder your here none null"
)
FEATURES = ("length", "changes", "pairs", "digits", "capitals", "distinct_signs", "dictionary", "issuer", "hex_only", "digits_only", "shaped", "keyed", "near_key", "harmless", "address", "test_path")


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


_KEY, _JOIN = "[A-Za-z_][A-Za-z0-9_.-]{1,40}", r"""\\*["']?[=:]+>?\\*["']?"""
# possessive, so that a run of any length is matched in a loop and never twice
_RUN = r"""(?:[^"'`()<>\[\]{},;:@?&]++|[?&](?![A-Za-z_][A-Za-z0-9_.-]{0,40}=))++"""
#: A user and a password in an address, a value with its key, or a value alone.
_LOGIN = rf"""(?:{_KEY}{_JOIN})?[A-Za-z][A-Za-z0-9+.-]{{0,30}}://[^/?#"'<>:@]{{0,200}}:([^"'<>@]{{1,1000}})@"""
_KEYED = rf"""[-$?&*.!#|~+%/\\]*({_KEY}){_JOIN}({_RUN})"""
_PIECE = rf"{_LOGIN}|{_KEYED}|{_RUN}"

#: A word that names a secret, alone or as part of a name such as DB_PASSWORD.
_NAMES_SECRET = f"(?i)(?<![A-Za-z])(?:{_KEYS})(?![A-Za-z])"
_HOLDS_KEY = rf"""(?i)(?:{_KEYS})[A-Za-z0-9_.-]{{0,40}}{_JOIN}.{{6}}"""

_BLOCK = "(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----"
_SPACE = "[\\x20\\x09-\\x0D]+"
#: Only a block holds this, since a word holds no space.
_IS_BLOCK = "contains({}, 'PRIVATE KEY-----')"


def _in_pieces(of_segment: str, of_block: str) -> str:
    """An array of what stands for each word, and for each whole block of a private key, of @text@; ``s`` is the text between blocks, ``b`` a block."""
    between = f"""transform(array(regexp_extract_all(@text@, {_literal(_BLOCK)}, 0)), bs ->
      flatten(transform(split(@text@, {_literal(_BLOCK)}), (s, k) -> IF(k < size(bs), concat({of_segment}, transform(array(bs[k]), b -> {of_block})), {of_segment}))))[0]"""
    return f"""IF({_IS_BLOCK.format("@text@")}, {between}, transform(array(@text@), s -> {of_segment})[0])"""


#: Words and blocks, and the space behind each.
_WORDS = _in_pieces(f"split(s, {_literal(_SPACE)})", "b")
_SPACES = _in_pieces(f"concat(regexp_extract_all(s, {_literal(_SPACE)}, 0), array(''))", "''")

#: Of a text with blocks, the place of each word and block among the words of the whole text.
_PLACES = f"""
IF({_IS_BLOCK.format("@text@")}, transform(array(regexp_extract_all(@text@, {_literal(_BLOCK)}, 0)), bs -> transform(array(split(@text@, {_literal(_BLOCK)})), ss ->
  transform(array(transform(ss, (s, k) -> size(split(s, {_literal(_SPACE)})) - 1 + IF(k < size(bs), size(split(bs[k], {_literal(_SPACE)})) - 1, 0))), ns ->
    flatten(transform(ss, (s, k) -> transform(array(aggregate(slice(ns, 1, k), 0, (n, x) -> n + x)), first -> transform(
      sequence(0, size(split(s, {_literal(_SPACE)})) - IF(k < size(bs), 0, 1)), j -> first + least(j, size(split(s, {_literal(_SPACE)})) - 1)))[0])))[0])[0])[0], array())
"""

# words are looked at cheaply first: few are long or hold a sign that a key or a login needs, and few texts name a secret
_CANDIDATES = f"""
transform(array({_WORDS}), w -> transform(array({_PLACES}), places -> transform(array(IF(@text@ RLIKE {_literal(_NAMES_SECRET)}, transform(w, x -> length(x) >= 3 AND x RLIKE {_literal(_NAMES_SECRET)}), array())), names ->
  transform(
    filter(sequence(0, size(w) - 1), i -> length(w[i]) >= 6 AND (
      length(w[i]) >= 12 AND w[i] RLIKE '[0-9]' OR {_IS_BLOCK.format("w[i]")}
      OR (contains(w[i], '=') OR contains(w[i], ':')) AND (w[i] RLIKE {_literal(_HOLDS_KEY)} OR contains(w[i], '://') AND w[i] RLIKE {_literal(_LOGIN)})
      OR coalesce(get(names, i - 1), false) OR coalesce(get(names, i - 2), false) OR coalesce(get(names, i - 3), false))),
    i -> named_struct(
      'piece', i, 'at', coalesce(get(places, i), i), 'word', w[i],
      'before', IF({_IS_BLOCK.format("w[i]")}, '', array_join(transform(slice(w, greatest(i - 2, 1), least(i, 3)), x -> IF({_IS_BLOCK.format("x")}, '', x)), ' ')),
      'after', IF({_IS_BLOCK.format("w[i]")}, '', array_join(transform(slice(w, i + 2, 2), x -> IF({_IS_BLOCK.format("x")}, '', x)), ' ')))))[0])[0])[0]
"""

#: Key and value of a piece of a word; each pattern is tried once, and only where the piece holds its sign.
_SPLIT = f"""
transform(array(named_struct('login', IF(contains(m, '://'), regexp_extract(m, {_literal(f"^{_LOGIN}$")}, 1), ''), 'keyed', (contains(m, '=') OR contains(m, ':')) AND m RLIKE {_literal(f"^{_KEYED}$")})), x -> CASE
  WHEN x.login != '' THEN named_struct('key', 'password', 'value', rtrim({_literal('.' + chr(92))}, x.login))
  WHEN x.keyed THEN named_struct('key', regexp_extract(m, {_literal(f"^{_KEYED}$")}, 1), 'value', rtrim({_literal('.' + chr(92))}, regexp_extract(m, {_literal(f"^{_KEYED}$")}, 2)))
  ELSE named_struct('key', '', 'value', rtrim({_literal('.' + chr(92))}, m)) END)[0]
"""

_PAIRS_OF_WORDS = f"""
flatten(transform(@found@, c -> IF({_IS_BLOCK.format("c.word")},
  array(named_struct('piece', c.piece, 'at', c.at, 'word', c.word, 'before', '', 'after', '', 'key', 'private key', 'value', c.word)),
  transform(transform(regexp_extract_all(c.word, {_literal(_PIECE)}, 0), m -> {_SPLIT}), p -> named_struct('piece', c.piece, 'at', c.at, 'word', c.word, 'before', c.before, 'after', c.after, 'key', p.key, 'value', p.value)))))
"""

#: A value that is a key and its value (export:PASSWORD=...) gives that value too.
_PARTS = f"""
flatten(transform({_PAIRS_OF_WORDS}, c -> IF((contains(c.value, '=') OR contains(c.value, ':')) AND NOT {_IS_BLOCK.format("c.value")} AND c.value RLIKE {_literal(f"^{_KEYED}$")},
  array(c, named_struct('piece', c.piece, 'at', c.at, 'word', c.word, 'before', c.before, 'after', c.after,
    'key', regexp_extract(c.value, {_literal(f"^{_KEYED}$")}, 1), 'value', regexp_extract(c.value, {_literal(f"^{_KEYED}$")}, 2))), array(c))))
"""

_FEATURES = rf"""
transform(filter(@parts@, c -> length(c.value) >= 6), c -> named_struct('piece', c.piece, 'at', c.at, 'value', c.value, 'x', named_struct(
  'length', CAST(length(c.value) AS DOUBLE),
  'changes', (size(regexp_extract_all(c.value, '[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+', 0)) - 1) / CAST(length(c.value) AS DOUBLE),
  'pairs', size(regexp_extract_all(lower(c.value), '{_PAIRS}', 0)) / CAST(length(c.value) AS DOUBLE),
  'digits', length(regexp_replace(c.value, '[^0-9]', '')) / CAST(length(c.value) AS DOUBLE),
  'capitals', length(regexp_replace(c.value, '[^A-Z]', '')) / CAST(length(c.value) AS DOUBLE),
  'distinct_signs', size(array_distinct(split(c.value, ''))) / CAST(length(c.value) AS DOUBLE),
  'dictionary', 1 - length(regexp_replace(lower(c.value), '{"|".join(_DICTIONARY.split())}', '')) / CAST(length(c.value) AS DOUBLE),
  'issuer', CAST(c.value RLIKE '^(?:{_PREFIXES})' AS DOUBLE),
  'hex_only', CAST(c.value RLIKE '^[0-9a-f]+$|^[0-9A-F]+$' AS DOUBLE),
  'digits_only', CAST(c.value RLIKE '^[0-9.,+()/-]+$' AS DOUBLE),
  'shaped', CAST(c.value RLIKE '^[0-9a-fA-F]{{8}}(?:-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$|^[0-9]{{1,4}}([.:/-][0-9]{{1,4}})+$|^v?[0-9]+[.][0-9]+' AS DOUBLE),
  'keyed', CAST(c.key RLIKE '(?i){_KEYS}' AS DOUBLE),
  'near_key', CAST(c.before RLIKE {_literal(_NAMES_SECRET)} AS DOUBLE),
  'harmless', CAST(concat_ws(' ', c.key, c.before, c.after) RLIKE '(?i)\\b(?:{_HARMLESS})\\b' AS DOUBLE),
  'address', CAST(c.word RLIKE '@|://|^/|[.](?:com|org|net|html)' AS DOUBLE),
  'test_path', CAST(@path@ RLIKE '(?i)test|example|sample|docs|fixture|mock' AS DOUBLE))))
"""


def _featured(docs: DataFrame, path: str | None) -> DataFrame:
    """``docs`` with the array ``found``: piece (of the text, where a block is one), at, value and features x of each candidate."""
    text, where = F.col("text"), F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    held = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "secret_text" and c != "secret_path"], F.coalesce(text, F.lit("")).alias("secret_text"), where.alias("secret_path"))
    parts = _PARTS.replace("@found@", _CANDIDATES).replace("@text@", "secret_text")
    return held.withColumn("found", F.expr(_FEATURES.replace("@parts@", parts).replace("@path@", "secret_path"))).drop("secret_text", "secret_path")


def labelled_findings(spark: SparkSession, n: int = 3000) -> DataFrame:
    """``text``, ``path``, ``label`` and ``shape`` (the rule) of ``n`` findings made by rules from hashes of their numbers; the same each time."""
    hexed = "sha2(concat('finding ', id), 256)"
    letters = f"translate(base64(unhex({hexed})), '+/=', 'xyz')"
    capitals = f"upper(translate({letters}, '0189', 'abcd'))"
    number = f"substr(translate({hexed}, 'abcdef', '123456'), 1, {{}})"
    uuid = f"concat_ws('-', substr({hexed}, 1, 8), substr({hexed}, 9, 4), substr({hexed}, 13, 4), substr({hexed}, 17, 4), substr({hexed}, 21, 12))"
    word = "element_at(array('orange', 'river', 'the', 'of', 'report', 'und', 'para', 'les', 'window', 'sunrise'), CAST(pmod(xxhash64(id, {}), 10) AS INT) + 1)"
    prose = (
        "element_at(array('garden', 'management', 'zwischen', 'Vereinbarung', 'economics', 'histoire', 'personnes', 'ciudad', 'importante', 'recipes', 'yesterday', 'reports', 'everything', 'Gesellschaft', "
        "'quelque', 'siempre', 'required', 'standard', 'Beteiligten', 'toujours', 'through', 'knowledge', 'trabajo', 'mystery', 'Ciónesó', 'Größenmaß', 'élémentaire', 'atención', 'Überprüfung', 'français'), CAST(pmod(xxhash64(id, {}), 30) AS INT) + 1)"
    )
    no_digits = f"substr(translate({letters}, '0123456789', 'kVbQmZpXtW'), 1, CAST(14 + id % 10 AS INT))"
    name = "element_at(array('hunter', 'tiger', 'moon', 'blue', 'Falcon', 'rocket', 'Coffee'), CAST(pmod(xxhash64(id, 8), 7) AS INT) + 1)"
    secret = [
        f"concat('AKIA', substr({capitals}, 1, 16))",
        f"concat('secret = ', chr(39), substr({hexed}, 1, 48), chr(39))",
        f"concat('api_key = \"', substr({hexed}, 1, CAST(28 + id % 8 AS INT)), '\"')",
        f"concat('password=', substr({hexed}, 1, 18))",
        f"concat('ghp_', substr({letters}, 1, 36))",
        f"concat('aws_secret_access_key=', substr({letters}, 1, 40))",
        f"concat('api_key: \"', substr({letters}, 1, 32), '\"')",
        f"concat('sk_live_', substr({letters}, 1, 24))",
        f"concat('Bearer eyJ', substr({letters}, 1, 40))",
        f"concat('password: ', substr({letters}, 1, 14))",
        f"concat('secret=', substr({letters}, 1, 20))",
        f"concat('token: ', substr({hexed}, 1, 32))",
        f"concat('AKIA', substr({capitals}, 3, 16), '.')",
        f"concat('{{\"user\":\"bob\",\"password\":\"', substr({letters}, 1, 14), '\"}}')",
        f"concat('{{\"id\":\"', id % 1000, '\",\"api_key\":\"', substr({hexed}, 1, 24), '\"}}')",
        f"concat(element_at(array('postgres', 'mysql', 'https', 'amqp'), CAST(id % 4 AS INT) + 1), '://admin:', substr({letters}, 1, CAST(10 + id % 12 AS INT)), '@', element_at(array('db/p', 'h1', 'a.com', 'b.org'), CAST(id % 4 AS INT) + 1))",
        f"concat('{{\"user\":\"bob\",\"password\":\"', {name}, substr({letters}, 1, CAST(5 + id % 6 AS INT)), '\"}}')",
        f"concat('password=', {name}, substr({letters}, 1, CAST(5 + id % 6 AS INT)))",
        f"concat('password: ', substr({letters}, 1, CAST(8 + id % 6 AS INT)))",
        f"concat('pwd=', substr({letters}, 1, CAST(7 + id % 8 AS INT)))",
        f"concat('secret: ', {no_digits})",
        f"concat('Bearer ', {no_digits})",
        f"concat('DB_PASSWORD: ', {name}, substr({letters}, 1, CAST(5 + id % 6 AS INT)))",
        f"concat('Name=prod;AccountKey=', substr({letters}, 1, 40), '==;Port=1')",
        f"concat('-----BEGIN ', element_at(array('RSA ', 'EC ', '', 'OPENSSH '), CAST(id % 4 AS INT) + 1), 'PRIVATE KEY-----\n', substr({letters}, 1, 43), '\n', substr({letters}, 3, 40), '\n-----END ', element_at(array('RSA ', 'EC ', '', 'OPENSSH '), CAST(id % 4 AS INT) + 1), 'PRIVATE KEY-----')",
    ]
    harmless = [
        f"concat('commit ', substr({hexed}, 1, 40))",
        f"concat('md5 checksum ', substr({hexed}, 1, 32))",
        f"concat('id ', {uuid})",
        f"concat('card ', {number.format(16)})",
        f"{number.format(16)}",
        f"concat('call +1-', {number.format(3)}, '-', {number.format(3)}, '-', {number.format(4)})",
        f"concat_ws('.', {number.format(3)}, substr({hexed}, 3, 2), '185', '10.255.255.1')",
        f"concat('https://www.example.com/page/', {number.format(8)}, '.html')",
        f"concat('user.', {number.format(2)}, '@mail', {number.format(1)}, '.example.com')",
        "concat('password=changeme', id % 100)",
        "concat('password=your_password_here_', id % 10)",
        "concat('token=example_token_', id % 1000)",
        "concat('AKIAIOSFODNN', id % 10, 'EXAMPLE')",
        "concat('column_name_', id % 1000, '_index')",
        f"concat('version v', {number.format(2)}, '.', {number.format(3)}, '.0-release')",
        f"substr({hexed}, 1, 40)",
        f"concat('ISBN 978-', {number.format(9)})",
        "concat('report2024summary', id % 100)",
        f"concat('etag \"', substr({hexed}, 1, 32), '\"')",
        f"concat({number.format(4)}, '-10-12T10:', {number.format(2)}, ':00Z')",
        f"concat('{{\"id\":\"', {number.format(8)}, '\",\"name\":\"orange', id % 100, '\"}}')",
        f"concat('{{\"created\":\"', {number.format(4)}, '-10-12\",\"commit\":\"', substr({hexed}, 1, 40), '\"}}')",
        "concat('Server=db', id % 100, '.local.net;Database=reports', id % 10, ';Password=changeme', id % 100)",
        f"concat('https://www.example.org:8080/page/', {number.format(6)}, '?item=', {number.format(8)}, '&order=', {number.format(7)})",
        "concat('postgres://admin:password', id % 100, '@localhost:5432/reports')",
        f"concat('the secret ', {prose.format(6)}, ' ', {prose.format(7)})",
        f"concat('password ', {prose.format(6)}, ' ', {prose.format(7)})",
        f"concat('Private ', initcap({prose.format(6)}), ' ', {prose.format(7)})",
        f"concat('token ', {prose.format(6)}, ', ', {number.format(6)}, ' ', {prose.format(7)}, '.')",
        "concat('secret password: ', element_at(array('changeme', 'example', 'placeholder', 'required', 'password'), CAST(id % 5 AS INT) + 1))",
        f"concat('auth ', upper({prose.format(6)}), ' ', {prose.format(7)}, '-', {prose.format(5)})",
    ]
    kinds = [(x, 1) for x in secret] + [(x, 0) for x in harmless]
    core = "CASE " + " ".join(f"WHEN kind = {i} THEN {x}" for i, (x, _) in enumerate(kinds)) + " END"
    rows = spark.range(n).selectExpr("id", f"CAST(pmod(id, {len(kinds)}) AS INT) AS kind")
    # after a secret only words too short for candidates, so that its text holds one finding
    after = lambda k: f"IF(kind < {len(secret)} AND length({word.format(k)}) >= 6, 'para', {word.format(k)})"
    return rows.selectExpr(
        f"concat_ws(' ', {word.format(1)}, {word.format(2)}, {word.format(3)}, {core}, {after(4)}, {after(5)}) AS text",
        "element_at(array('src/main', 'src3', 'docs/readme', 'tests/unit', 'crawl'), CAST(pmod(xxhash64(id, 9), 5) AS INT) + 1) AS path",
        f"CAST(kind < {len(secret)} AS INT) AS label",
        "kind AS shape",
    )


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> tuple | float:
    """A tree: (feature, threshold, left for <=, right), or a leaf's share of secrets."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * LEAST_LEAF or share in (0.0, 1.0):
        return round(share, 4)
    best = None
    for f in rng.permutation(x.shape[1])[: max(1, int(np.sqrt(x.shape[1])) + 1)]:
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(v))
        cut = np.flatnonzero((v[1:] > v[:-1]) & (n >= LEAST_LEAF) & (len(v) - n >= LEAST_LEAF))
        if not len(cut):
            continue
        nl, pl = cut + 1.0, ones[cut]
        nr, pr = len(v) - nl, ones[-1] - pl
        impurity = pl * (nl - pl) / nl + pr * (nr - pr) / nr
        k = int(impurity.argmin())
        if best is None or impurity[k] < best[0]:
            best = (impurity[k], int(f), float(v[cut[k]] + v[cut[k] + 1]) / 2)
    if best is None:
        return round(share, 4)
    _, f, at = best
    left = x[:, f] <= at
    return f, at, grow(x[left], y[left], rng, depth - 1), grow(x[~left], y[~left], rng, depth - 1)


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list:
    rng, forest = np.random.default_rng(seed), []
    for _ in range(trees if len(y) else 0):
        pick = rng.integers(0, len(y), len(y))
        forest.append(grow(x[pick], y[pick], rng, depth))
    return forest


def forest_sql(forest: list, x: str) -> str:
    """The mean of the trees as SQL over the struct ``x``."""

    def tree(node) -> str:
        if not isinstance(node, tuple):
            return f"{node}D"
        f, at, left, right = node
        return f"IF({x}.{FEATURES[f]} <= {at!r}D, {tree(left)}, {tree(right)})"

    return "(" + " + ".join(map(tree, forest)) + f") / {len(forest)}D" if forest else "0.0D"


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list:
    """A forest from ``text``, ``label`` and ``path``; a text with several candidates teaches its label for each."""
    rows = _featured(labelled.select("text", "path", "label"), "path").select("label", F.explode("found").alias("c")).select("label", "c.x.*")
    rows = rows.orderBy(F.xxhash64("label", *FEATURES), "label").limit(MOST_FINDINGS)
    held = sorted(tuple(float(r[f]) for f in FEATURES) + (float(r["label"]),) for r in rows.collect())
    data = np.array(held, np.float64).reshape(len(held), len(FEATURES) + 1)
    return fit_forest(data[:, :-1], data[:, -1], trees, depth)


def scored(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = "source") -> DataFrame:
    """``docs`` with the array ``found``: piece, at (the word's place), value and score of each candidate."""
    forest = train(labelled if labelled is not None else labelled_findings(docs.sparkSession))
    return _featured(docs, path).withColumn("found", F.expr(f"transform(found, c -> named_struct('piece', c.piece, 'at', c.at, 'value', c.value, 'score', {forest_sql(forest, 'c.x')}))"))


def findings(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, at, value, score and is_secret."""
    columns = ["doc_id", "text", *([path] if path else [])]
    return scored(docs.select(*columns), labelled, path).select("doc_id", F.inline("found")).drop("piece").withColumn("is_secret", F.col("score") >= threshold)


def redact(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = "source", threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced where it stands, and nowhere else; ``n_chars`` follows the text."""
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text", *([F.col(path).alias("path")] if path else []))
    found = scored(held, labelled, "path" if path else None).withColumn("found", F.expr(f"filter(found, c -> c.score >= {threshold}D)"))
    # of a word's secrets the longest goes first
    at = f"aggregate(array_sort(transform(filter(found, c -> c.piece = i), c -> c.value), (a, b) -> length(b) - length(a)), w, (t, v) -> replace(t, v, '{mark}'))"
    new = f"transform(array(transform(found, c -> c.piece)), held -> transform(zip_with({_WORDS}, {_SPACES}, (w, space) -> named_struct('w', w, 'space', space)), (p, i) -> concat(IF(array_contains(held, i), {at.replace(', w,', ', p.w,')}, p.w), p.space)))[0]"
    clean = found.withColumn("clean", F.expr(f"IF(size(found) = 0, text, array_join({new.replace('@text@', 'text')}, ''))"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return clean.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in columns])
