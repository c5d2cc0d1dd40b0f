"""Secret scans: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs that may be a secret; they must hold a letter and a digit. All values after a key and = or : count too; those end
#: before the next parameter of a URL.
RUN = "[A-Za-z0-9+/_-]{16,}={0,2}"
KEY = "(?i)(?:password|passwd|pwd|secret|token|api_?key|access_?key)"
VALUE = "(?:(?!&[A-Za-z0-9_.-]+=)[^\\s\"'=:,;]){6,}"
ASSIGNED = KEY + "[\"']?[ \\t]*[=:][ \\t]*[\"']?(?=" + VALUE + ")"
MARK, IN_TEXT = "\u0001", "\u0002"
# Words that stand next to secrets, words that stand next to other long values, prefixes of issued keys.
SECRET_WORDS = "password|passwd|pwd|secret|token|api_?key|apikey|access_?key|credential|auth|bearer|private"
OTHER_WORDS = "sha1|sha256|sha|md5|hash|commit|checksum|digest|etag|uuid|guid|revision|example|dummy|sample|placeholder|version|build|image|file|path"
PREFIXES = "^(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|xox[abp]-|sk_live_|sk-|AIza|eyJ)"
# The dictionary, whose words cover most of an identifier, path or placeholder but little of a secret.
DICTIONARY = [
    "access", "account", "admin", "agent", "alpha", "archive", "array", "assets", "backup", "base", "beta", "bin", "build", "cache", "change",
    "class", "client", "cloud", "code", "config", "connect", "content", "copy", "core", "create", "data", "date", "debug", "default", "demo",
    "dev", "dir", "doc", "document", "download", "dummy", "element", "email", "engine", "error", "event", "example", "export", "file",
    "filter", "final", "folder", "format", "from", "function", "goes", "group", "handler", "helper", "here", "home", "host", "html", "image",
    "import", "index", "info", "input", "insert", "integration", "interface", "item", "java", "key", "lib", "list", "local", "log", "main",
    "manager", "map", "message", "method", "model", "module", "name", "network", "number", "object", "output", "package", "page", "param",
    "pass", "password", "path", "placeholder", "prod", "project", "python", "query", "release", "report", "request", "response", "result",
    "sample", "schema", "script", "secret", "server", "service", "session", "set", "share", "size", "source", "space", "spark", "stage",
    "state", "static", "string", "system", "table", "target", "task", "temp", "test", "text", "the", "thread", "time", "token", "tool",
    "type", "update", "upload", "url", "user", "util", "value", "var", "version", "view", "web", "work", "worker", "write", "your",
]
FEATURES = ["length", "transitions", "digits", "uppers", "distinct", "coverage", "slashes", "path", "near_secret", "near_other", "issued", "hex", "uuid", "dashes"]
#: Findings that the default forest is trained on.
FINDINGS = 6000


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start (characters before the value), value, token, before (two words), after (one word) of each candidate."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    runs = F.regexp_extract_all(F.col("_text"), F.lit(RUN), F.lit(0))
    some = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).where(F.exists(runs, mixed) | F.col("_text").rlike(ASSIGNED))
    # The mark stands before each assigned value; it changes no white space, so both arrays have the same words.
    marked = F.regexp_replace(F.translate("_text", MARK, IN_TEXT), ASSIGNED, f"$0{MARK}")
    words = some.select("_id", F.split("_text", "[ \\t\\r\\n]").alias("_w"), F.split(marked, "[ \\t\\r\\n]").alias("_m"))
    tokens = F.filter(
        F.transform("_w", lambda w, i: F.struct(i.alias("i"), w.alias("w"), F.get(F.col("_m"), i).alias("m"))),
        lambda x: x["w"].rlike("[A-Za-z0-9+/_-]{16}") | F.contains(x["m"], F.lit(MARK)),
    )
    # Characters from one token to the next, each word counted once, then their running sums.
    own = words.select("_id", "_w", tokens.alias("_t"))
    before = lambda j: F.coalesce(F.get(F.col("_t.i"), j - 1), F.lit(0))
    gap = lambda x, j: F.aggregate(F.slice("_w", before(j) + 1, x["i"] - before(j)), F.lit(0).cast("bigint"), lambda a, w: a + F.length(w) + 1)
    placed = own.select("_id", "_w", "_t", _running(F.transform("_t", gap)).alias("_at"))

    def context(x, j):
        at = lambda d: F.coalesce(F.get(F.col("_w"), x["i"] + d), F.lit(""))
        return F.struct(
            F.get(F.col("_at"), j).alias("at"), x["w"].alias("token"), x["m"].alias("marked"), F.concat(at(-2), F.lit(" "), at(-1)).alias("before"), at(1).alias("after")
        )

    def spans(parts, pattern, fits):
        """value, off of what each part but the first begins with. The parts joined are as long as the token."""

        def told(p):
            ends = _running(F.transform(p, lambda x: F.length(x).cast("bigint")))
            value = lambda x: F.regexp_extract(x, f"^{pattern}", 0)
            found = F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x, j: F.struct(value(x).alias("value"), j.alias("part")))
            return F.transform(
                F.array(ends), lambda e: F.transform(F.filter(found, lambda v: fits(v["value"])), lambda v: F.struct(v["value"].alias("value"), F.get(e, v["part"]).alias("off")))
            )

        return F.get(F.flatten(F.transform(F.array(parts), told)), F.lit(0))

    found = placed.select("_id", F.explode(F.transform("_t", context)).alias("c"))
    token, cut = F.col("c.token"), lambda x: F.split(x, MARK)
    runs = spans(cut(F.regexp_replace(F.translate(token, MARK, IN_TEXT), RUN, f"{MARK}$0")), RUN, mixed)
    assigned = spans(cut(F.col("c.marked")), VALUE, lambda v: F.lit(True))
    both = found.select("_id", "c", F.array_sort(F.concat(runs, assigned)).alias("_s"))
    new = lambda x, i: (i == 0) | (F.get(F.col("_s.value"), i - 1) != x["value"])
    each = both.select("_id", "c", F.explode(F.filter("_s", new)).alias("v"))
    as_is = F.when(F.contains("c.token", F.lit(MARK)), F.substring(F.col("c.token"), (F.col("v.off") + 1).cast("int"), F.length("v.value"))).otherwise(F.col("v.value"))
    return each.select(
        F.col("_id").alias(id_col), (F.col("c.at") + F.col("v.off")).alias("start"), as_is.alias("value"), "c.token", "c.before", "c.after"
    )


def _running(lengths):
    """The running sums of an array of numbers, by doubling: each round adds the sums that lie 1, 2, 4, ... places before."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))
    return F.aggregate(
        rounds,
        lengths,
        lambda sums, r: F.zip_with(sums, F.slice(F.concat(F.array_repeat(F.lit(0).cast("bigint"), F.pow(F.lit(2), r).cast("int")), sums), F.lit(1), F.size(sums)), lambda x, y: x + y),
    )


def featured(found: DataFrame) -> DataFrame:
    """found with the columns of FEATURES, from value, token, before and after."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.length(F.regexp_replace(v, pattern, "")) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "1")
    around = F.lower(F.concat_ws(" ", "before", F.replace("token", "value", F.lit("")), "after"))
    number = lambda c: c.cast("double")
    columns = {
        "length": n,
        "transitions": (F.length(F.regexp_replace(classes, "(.)\\1+", "$1")) - 1) / n,
        "digits": share("[^0-9]"),
        "uppers": share("[^A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "coverage": 1 - F.length(F.regexp_replace(F.lower(v), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "slashes": share("[^/]"),
        "path": number(F.col("token").rlike("://|^[.~]{0,2}/|/[^/]*/|\\\\|\\.[a-z]{2,4}[\"',;)]*$")),
        "near_secret": number(around.rlike(SECRET_WORDS)),
        "near_other": number(around.rlike(f"(?:^|[^a-z])(?:{OTHER_WORDS})")),
        "issued": number(v.rlike(PREFIXES)),
        "hex": number(v.rlike("^[0-9a-f]+$")),
        "uuid": number(v.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")),
        "dashes": share("[^_-]"),
    }
    return found.withColumns({c: columns[c] for c in FEATURES})


def _kinds() -> list[tuple[str, str, str, str, str, int]]:
    """name, value, what stands before and after it in its token, the words before the token, label of each kind of
    finding, as SQL over id."""

    def word(seed, alphabet, n):
        return f"array_join(transform(sequence(1, {n}), i -> substr('{alphabet}', cast(pmod(xxhash64({seed}, id, i), {len(alphabet)}) AS int) + 1, 1)), '')"

    def listed(seed, n, sep):
        words = ", ".join(f"'{w}'" for w in DICTIONARY)
        return f"array_join(transform(sequence(1, {n}), i -> element_at(array({words}), cast(pmod(xxhash64({seed}, id, i), {len(DICTIONARY)}) AS int) + 1)), '{sep}')"

    def spoken(seed, n, sep, upper=False):
        """Words that can be said and stand in no dictionary."""
        syllable = lambda k: f"concat(substr('bcdfglmnprstv', cast(pmod(xxhash64({seed}, id, i, {k}), 13) AS int) + 1, 1), substr('aeiou', cast(pmod(xxhash64({seed}, id, i, {k}, 1), 5) AS int) + 1, 1))"
        made = f"concat({syllable(1)}, {syllable(2)}, if(pmod(xxhash64({seed}, id, i), 2) = 0, {syllable(3)}, substr('nrst', cast(pmod(xxhash64({seed}, id, i, 9), 4) AS int) + 1, 1)))"
        return f"array_join(transform(sequence(1, {n}), i -> {f'initcap({made})' if upper else made}), '{sep}')"

    up, low, hexa, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "0123456789"
    any_ = up + low + digits
    wide = "cast(24 + pmod(xxhash64(5, id), 40) AS int)"
    number, year = "cast(pmod(xxhash64(6, id), 9000) + 1000 AS string)", "cast(1995 + pmod(xxhash64(7, id), 30) AS string)"
    plain, talk = listed(9, 2, " "), spoken(10, 2, " ")
    return [
        ("aws key id", f"concat('AKIA', {word(1, up + '234567', 16)})", "''", "''", plain, 1),
        ("hex password", word(2, hexa, 18), "'password='", "''", plain, 1),
        ("hex token", word(3, hexa, 40), "'\"'", "'\"'", "'token ='", 1),
        ("hex secret", word(61, hexa, 32), "'secret='", "''", talk, 1),
        ("hex api key", word(62, hexa, 48), "'\"'", "'\"'", "'api_key ='", 1),
        ("hex bearer", word(63, hexa, 56), "''", "''", "'auth bearer'", 1),
        ("long secret", word(4, any_, wide), "'\"'", "'\"'", "'secret ='", 1),
        ("base64 key", word(5, any_ + "+/", wide), "'api_key='", "''", talk, 1),
        ("code host token", f"concat('ghp_', {word(6, any_, 36)})", "''", "''", talk, 1),
        ("payment key", f"concat('sk_live_', {word(7, any_, 24)})", "''", "','", plain, 1),
        ("short password", word(8, any_, "cast(8 + pmod(xxhash64(5, id), 16) AS int)"), "'password:'", "''", talk, 1),
        ("password with signs", f"concat({spoken(51, 1, '', True)}, {word(52, '!&$%*', 1)}, {word(53, digits, 2)}, {word(54, any_, 3)})", "'pwd='", "''", plain, 1),
        ("bearer", word(9, any_ + "_-", wide), "''", "''", "'Authorization: Bearer'", 1),
        ("chat token", f"concat('xoxb-', {word(55, digits, 12)}, '-', {word(56, any_, 24)})", "''", "''", talk, 1),
        ("map key", f"concat('AIza', {word(57, any_ + '_-', 35)})", "'key='", "''", talk, 1),
        ("query token", word(58, any_, 22), "'https://h/?token='", "'&x=1'", talk, 1),
        ("json secret", word(59, any_ + "+/", 32), "'{\"secret\":\"'", "'\"}'", plain, 1),
        ("commit", word(11, hexa, 40), "''", "''", "'commit'", 0),
        ("sha256", word(12, hexa, 64), "'sha256:'", "''", plain, 0),
        ("md5", word(13, hexa, 32), "'\"'", "'\"'", "'md5 ='", 0),
        ("uuid", f"concat({word(14, hexa, 8)}, '-', {word(15, hexa, 4)}, '-', {word(16, hexa, 4)}, '-', {word(17, hexa, 4)}, '-', {word(18, hexa, 12)})", "''", "''", plain, 0),
        ("path", f"concat({listed(19, 4, '/')}, '/', {number})", "'/'", "''", plain, 0),
        ("spoken path", f"concat('/', {spoken(31, 4, '/')}, {number})", "''", "'.txt'", talk, 0),
        ("snake name", f"concat({listed(20, 4, '_')}, '_', {number})", "''", "''", plain, 0),
        ("placeholder", f"concat({listed(21, 3, '-')}, '-', {number})", "'api_key='", "''", plain, 0),
        ("your key here", "concat('your-api-key-goes-here-', cast(pmod(id, 10) AS string))", "'token='", "''", plain, 0),
        ("crosses", "concat(repeat('x', 16), cast(pmod(id, 100) AS string))", "'password='", "''", plain, 0),
        ("words and number", f"concat({listed(22, 3, '')}, {number})", "''", "''", plain, 0),
        ("url", f"concat({listed(23, 3, '/')}, '/', {word(24, hexa, 12)})", "'https://example.com/'", "''", plain, 0),
        ("spoken slug", f"concat({spoken(32, 5, '-')}, '-', {year})", "''", "''", talk, 0),
        ("camel case", f"concat({spoken(33, 4, '', True)}, cast(pmod(id, 10) AS string))", "''", "'()'", talk, 0),
        ("picture", f"concat('IMG_', {year}, {word(34, '0', 1)}, {word(35, '123456789', 1)}, '12_', {word(36, digits, 6)})", "''", "'.jpg'", talk, 0),
        ("time", f"concat({year}, '-', '0', {word(37, '123456789', 1)}, '-1', {word(38, digits, 1)}, 'T', {word(39, '01', 1)}, {word(40, digits, 1)}, '-00-00Z')", "''", "''", talk, 0),
        ("package", f"concat({spoken(41, 2, '-')}, '-', {word(42, digits, 1)}, '-', {word(43, digits, 2)}, '-linux-x86_64')", "''", "''", talk, 0),
        ("spoken value", f"concat({spoken(44, 2, '-')}, '-', {listed(45, 1, '')})", "'token:'", "''", talk, 0),
        ("letters and number", f"concat({word(25, low, 14)}, {number})", "''", "'.'", plain, 0),
    ]


KINDS = _kinds()


def labelled_findings(spark: SparkSession, rows: int = FINDINGS, without: tuple[str, ...] = ()) -> DataFrame:
    """kind, value, token, before, after, label: findings of the known kinds but those left out, made by rule from hashes of
    their number."""
    kinds = [k for k in KINDS if k[0] not in without]
    pick = lambda i: "CASE n " + " ".join(f"WHEN {n} THEN {kind[i]}" for n, kind in enumerate(kinds)) + " END"
    words = ", ".join(f"'{w}'" for w in DICTIONARY)
    after = f"element_at(array({words}), cast(pmod(xxhash64(29, id), {len(DICTIONARY)}) AS int) + 1)"
    names = "array(" + ", ".join(f"'{k[0]}'" for k in kinds) + ")"
    made = spark.range(rows, numPartitions=1).withColumn("n", F.pmod(F.xxhash64(F.lit(99), "id"), F.lit(len(kinds))).cast("int"))
    return made.selectExpr(f"{names}[n] AS kind", f"{pick(1)} AS value", f"{pick(2)} AS head", f"{pick(3)} AS tail", f"{pick(4)} AS before", f"{after} AS after", f"{pick(5)} AS label").selectExpr(
        "kind", "value", "concat(head, value, tail) AS token", "before", "after", "cast(label AS double) AS label"
    )


def forest(findings: DataFrame, trees: int = 32, depth: int = 8, seed: int = 11) -> RandomForestClassificationModel:
    """A random forest trained from labelled findings (value, token, before, after, label)."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured(findings)).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def secret_scan(docs: DataFrame, model: RandomForestClassificationModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: id, start, length, value, score, is_secret.

    Candidates are all runs of 16 or more of A-Z, a-z, 0-9, +, /, _ and - that hold a letter and a digit, and all values of
    6 or more characters after a key such as password= or token:, also with blanks (not line breaks) around = and :. Where
    an assigned value goes on beyond a run in it, both are candidates. start counts the characters before the value in
    the whole text, at its first match in its word; the same value in one word counts once. The forest judges each by length, character
    transitions and shares, dictionary coverage, path and neighbouring words; is_secret tells that the share of its
    vote reaches the threshold.

    Time and memory grow with a text's length, also where it holds very many candidates. Null and empty texts have no
    candidate. Repeated rows give repeated results; empty input gives no rows; further
    columns are ignored, also those with names of features.
    """
    rows = featured(candidates(docs, id_col, text_col))
    voted = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    score = vector_to_array("probability")[1]
    return voted.select(
        id_col, "start", F.length("value").alias("length"), "value", score.alias("score"), (score >= threshold).alias("is_secret")
    )
