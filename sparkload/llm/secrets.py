"""Secret scan: candidates from a pattern, judged by a random forest trained on labelled findings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, text_of

TRAINING_ROWS = 10_000  # expected number of sampled findings of either label
TREES, DEPTH = 30, 7
LEAST_LENGTH = 8
BEFORE, AFTER = 60, 40  # characters of context

# Names that secrets are assigned to, and words that speak against one.
SECRET_WORDS = "secret|password|passwd|pwd|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|credential|auth|bearer"
HARMLESS_WORDS = "example|sample|dummy|test|fake|placeholder|phone|tel|call|card|order|invoice|isbn|date|version|commit|sha|md5|uuid"
# Words that identifiers and prose are made of.
DICTIONARY = (
    "access account address admin amount api app auth bank base bin call card check class client code com config count data date day "
    "default description doc email error event example file first for from group hash host html http id image index info int item key last "
    "lib line link list log login main map master max message min mode model name net new node null number object order org page part pass path "
    "phone php port post process product query request response result role root row sample secret server service session set size sort source "
    "start state status string table tag temp test text the time title token type update url user value version view web word www year"
).split()
# Forms that issuers give to their keys.
ISSUED = (
    r"^(AKIA|ASIA)[A-Z0-9]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36,}$",
    r"^sk_(live|test)_[A-Za-z0-9]{16,}$",
    r"^xox[abpr]-[A-Za-z0-9-]{10,}$",
    r"^AIza[A-Za-z0-9_-]{35}$",
    r"^glpat-[A-Za-z0-9_-]{20}$",
)

# A run of token characters with a digit in it or of an issuer's form, not cut out of a longer one.
_TOKEN = r"[A-Za-z0-9+/_\-]"
CANDIDATE = rf"(?<!{_TOKEN})(?:(?=[A-Za-z+/_\-]*[0-9])|(?=(?:{'|'.join(x[1:-1] for x in ISSUED)})(?!{_TOKEN}))){_TOKEN}{{{LEAST_LENGTH},}}"

# Whatever is assigned to a name for secrets or quoted after one, and the password of an address: in quotes all up to the closing
# one, otherwise all up to a space, a quote that closes, or the next assignment. For Java, whose lookbehinds may vary in length; the
# short one in front is cheap and holds nearly nowhere.
_NAME = rf"(?i:{SECRET_WORDS})[A-Za-z0-9_\-]{{0,24}}"
_ASSIGNED = (
    r"(?<=[=:>\s\"'`])(?<=[=:]>?\s{0,20}[\"'`]?|\s[\"'`])"
    rf"(?<={_NAME}[\"'`\])]{{0,2}}\s{{0,20}}[:=]{{1,2}}>?\s{{0,20}}[\"'`]?|{_NAME}\s{{1,20}}[\"'`])"
)
_VALUE = (
    r"(?:(?<=\")[^\"\n]+(?=\")|(?<=')[^'\n]+(?=')|(?<=`)[^`\n]+(?=`)"
    r"|(?![\"'`=:>])(?:(?![,;&]\s{0,4}[\w.\-]{1,40}\s{0,4}[=:]|[\"'`](?:[\s,;)}\]]|$))\S)+)"
)
_ADDRESS = r"(?<=:)(?<=://[^\s:/@]{0,64}:)[^\s/\"']+(?=@)"
_CANDIDATES = f"{_ASSIGNED}{_VALUE}|{_ADDRESS}|{CANDIDATE}"

FEATURES = (
    "length", "digits", "upper", "lower", "signs", "changes", "entropy", "distinct", "hex", "covered",
    "assigned", "quoted", "named", "harmless", "letters_before", "path_depth", "path_harmless",
)


def candidates(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, place, path, value, before, after`` of every candidate; ``place`` counts those of a text.

    Candidates are runs of token characters with a digit, the forms of issuers, and whatever is assigned to a name for secrets, quoted
    after one, or the password of an address, of any length and characters. The text is cut at its candidates, so that the work is in proportion
    to its length however many there are. Context reaches to the next candidate at most.
    """
    text = text_of(text_col)
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), text.alias("text"))
    rows = rows.select("id", "path", F.regexp_extract_all("text", F.lit(_CANDIDATES), F.lit(0)).alias("values"), F.split("text", _CANDIDATES).alias("between"))
    rows = rows.filter(F.size("values") > 0)
    around = F.transform(
        F.sequence(F.lit(0), F.size("values") - 1),
        lambda k: F.struct(
            k.alias("place"),
            F.get("values", k).alias("value"),
            F.right(F.get("between", k), F.lit(BEFORE)).alias("before"),
            F.left(F.get("between", k + 1), F.lit(AFTER)).alias("after"),
        ),
    )
    return rows.select("id", "path", F.explode(around).alias("c")).select("id", "c.place", "path", "c.value", "c.before", "c.after")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", f"[^{pattern}]", "")) / F.length("value")


def with_features(found: DataFrame, *keep: str) -> DataFrame:
    """The candidates, and the columns to keep, with ``features``: length, characters and their transitions, dictionary coverage, neighbouring words, path."""
    chars = F.array_distinct(F.split("value", ""))
    counts = F.transform(chars, lambda c: (F.length("value") - F.length(F.replace(F.col("value"), c, F.lit("")))).cast("double"))
    spread = F.aggregate(counts, F.lit(0.0), lambda s, n: s + F.when(n > 0, n * F.log2(n)).otherwise(0.0))
    changes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    word = "(?i)(" + "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=lambda w: (-len(w), w))) + ")"
    before, flag = F.lower("before"), lambda c: c.cast("double")
    columns = {
        "length": F.least(F.length("value"), F.lit(200)).cast("double"),
        "digits": _share("0-9"),
        "upper": _share("A-Z"),
        "lower": _share("a-z"),
        "signs": _share(r"+/_\-"),
        "changes": F.regexp_count("value", F.lit(changes)) / F.length("value"),
        "entropy": F.log2(F.length("value").cast("double")) - spread / F.length("value"),
        "distinct": F.size(chars) / F.length("value"),
        "hex": flag(F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "covered": 1 - F.length(F.regexp_replace("value", word, "")) / F.length("value"),
        "assigned": flag(F.col("before").rlike("[=:]\\s*[\"']?$")),
        "quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "named": flag(before.rlike(f"({SECRET_WORDS})\\W*$")),
        "harmless": flag(before.rlike(f"(^|[^a-z])({HARMLESS_WORDS})[^a-z]") | F.lower("after").rlike(f"(^|[^a-z])({HARMLESS_WORDS})([^a-z]|$)")),
        "letters_before": F.length(F.regexp_replace("before", "[^A-Za-z]", "")) / F.greatest(F.length("before"), F.lit(1)),
        "path_depth": F.size(F.split("path", "/")).cast("double"),
        "path_harmless": flag(F.lower("path").rlike(f"(^|[^a-z])(tests?|examples?|samples?|docs?|{HARMLESS_WORDS})([^a-z]|$)")),
    }
    numbers = found.select("id", "place", "value", *keep, *[c.cast("double").alias(k) for k, c in columns.items()])
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(numbers).drop(*FEATURES)


def rule_label(value: Column, before: Column) -> Column:
    """Label of a finding by strict rules, null where they do not decide: for training where nobody has labelled.

    A secret has an issuer's form, or letters and digits, or signs that prose has not, assigned to a name for secrets. Digits alone, and
    what has a harmless word right before it, is none.
    """
    issued = value.rlike("|".join(ISSUED))
    assigned = F.lower(before).rlike(f"({SECRET_WORDS})[\"']?\\s*[=:]\\s*[\"']?$") & value.rlike(r"^\S*([0-9]|[^\w\s.,;:/()'\"-])\S*$") & (F.length(value) >= 12)
    harmless = value.rlike(r"^[0-9+/_\-]+$") | F.lower(before).rlike(f"(^|[^a-z])({HARMLESS_WORDS})\\W*$")
    return F.when(issued | assigned, 1).when(harmless, 0)


@dataclass
class SecretModel:
    forest: RandomForestClassificationModel | None
    constant: float = 0.0  # where all labelled findings agree, or there are none

    def probability(self, featured: DataFrame) -> DataFrame:
        if self.forest is None:
            return featured.withColumn("p", F.lit(self.constant))
        return self.forest.transform(featured).withColumn("p", vector_to_array("probability")[1])


def fit_secret_model(labelled: DataFrame, rows: int = TRAINING_ROWS, trees: int = TREES, depth: int = DEPTH) -> SecretModel:
    """Forest fitted on labelled findings ``id, place, path, value, before, after, label`` (0 or 1; nulls are left out).

    ``rows`` is the expected number of findings sampled of either label, by a hash of the value, so that copies of one
    finding are taken or left together.
    """
    known = labelled.filter("label in (0, 1)")
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return SecretModel(None, float(next(iter(counts), 0)))
    draw = F.pmod(F.xxhash64(F.lit("secret"), "value", "id", "place"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("label") == 1, F.lit(rows / counts[1])).otherwise(F.lit(rows / counts[0]))
    chosen = stored(known.filter(draw < share), "labelled-findings")
    featured = with_features(chosen, "label").orderBy("id", "place", "value")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featuresCol="features", labelCol="label")
    taken = {r.label for r in featured.select("label").distinct().collect()}
    return SecretModel(forest.fit(featured)) if len(taken) == 2 else SecretModel(None, float(min(taken, default=0)))


def scan_secrets(
    docs: DataFrame, path: Column, labelled: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, place, prefix, length, digest, probability, is_secret`` of every candidate in every text.

    ``labelled`` has findings with labels; without it the strict rules of ``rule_label`` label the candidates at hand. Candidates
    are found in one pass over the texts and stored; no text is shuffled. The value itself is not given out: four characters, its
    length and its SHA-256 digest.

    Null and empty texts have no candidates; repeated rows and rows without an id have theirs; a null path is empty.
    """
    found = stored(candidates(docs, path, id_col, text_col), "candidates")
    if labelled is None:
        labelled = found.withColumn("label", rule_label(F.col("value"), F.col("before")))
    model = fit_secret_model(labelled)
    judged = model.probability(with_features(found))
    return judged.select(
        F.col("id").alias("doc_id"),
        "place",
        F.left("value", F.lit(4)).alias("prefix"),
        F.length("value").alias("length"),
        F.sha2("value", 256).alias("digest"),
        F.col("p").alias("probability"),
        (F.col("p") >= threshold).alias("is_secret"),
    )
