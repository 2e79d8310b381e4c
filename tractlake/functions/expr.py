"""Scalar expressions as Columns: cleaning, keys, predicates, tiers and classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
TIER_EDGES = (12.0, 40.0)
MOE_DIVISOR = 1.645
TOLERANCE = {"walk": (3.0, 0.15), "walk_transit": (10.0, 0.25)}
FORMULA_PREFIX = r"^[=+\-@\t\r]"
PLAIN_NUMBER = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
SLUG = r"^[a-z][a-z0-9_]*$"
PROHIBITED_TERMS = ("healthy", "unhealthy", "nutritious", "quality", "desert", "insecur", "score", "rank", "index")
LEAKS = (
    ("raw zone path", r"\braw/"),
    ("intermediate zone path", r"\bintermediate/"),
    ("curated zone path", r"\bcurated/"),
    ("quarantine zone path", r"\bquarantine/"),
    ("cache zone path", r"\bcache/"),
    ("state file", r"pipeline_state\.json"),
    ("drive-letter path", r"(^|[^A-Za-z])[A-Za-z]:[\\/]"),
    ("home directory path", r"(^|[^A-Za-z0-9])/(home|Users)/"),
    ("backslash path", r"\\\\"),
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text; nothing but blanks is null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def codes_to_null(c: Column | str, codes: tuple) -> Column:
    """Provider annotation codes are no values."""
    return F.when(~col(c).isin(*codes), col(c))


def lenient_number(c: Column | str) -> Column:
    return blank_to_null(c).try_cast("double")


def scoped_id(source: str, record: Column | str) -> Column:
    return F.concat_ws(":", F.lit(source), col(record).cast("string"))


def in_box(x: Column | str, y: Column | str, box: tuple[float, float, float, float]) -> Column:
    """Inside a closed box (west, south, east, north); missing coordinates are outside."""
    west, south, east, north = box
    return F.coalesce(col(x).between(west, east) & col(y).between(south, north), F.lit(False))


def escaped_formula(c: Column | str) -> Column:
    """Text that a spreadsheet would take for a formula gets a leading apostrophe."""
    return F.when(col(c).rlike(FORMULA_PREFIX), F.concat(F.lit("'"), col(c))).otherwise(col(c))


def safe_cell(c: Column | str) -> Column:
    """Whether a cell is no formula; a leading minus is fine on a plain number."""
    return F.coalesce(~col(c).rlike(FORMULA_PREFIX) | (col(c).startswith("-") & col(c).rlike(PLAIN_NUMBER)), F.lit(True))


def proper_name(c: Column | str) -> Column:
    """A lower-case slug without any prohibited term."""
    return reduce(lambda a, t: a & ~F.contains(col(c), F.lit(t)), PROHIBITED_TERMS, F.coalesce(col(c).rlike(SLUG), F.lit(False)))


def leak_labels(c: Column | str) -> Column:
    """The labels of all leak patterns found in a text."""
    return F.array_compact(F.array(*[F.when(col(c).rlike(p), F.lit(label)) for label, p in LEAKS]))


def metric_column(metric: Column | str, category: Column | str, mode: Column | str) -> Column:
    """metric[__category][__mode]; missing and empty parts are left out."""
    return F.concat_ws("__", *[F.nullif(col(c), F.lit("")) for c in (metric, category, mode)])


def visible_text(html: Column | str) -> Column:
    """The text of a page: scripts, styles, comments and tags out, entities decoded, white space folded."""
    out = F.regexp_replace(col(html), r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->|<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def canonical(c: Column | str) -> Column:
    """A number as text: null for missing, NaN and infinite ones, whole numbers without a point, others with six decimals."""
    x = col(c).cast("double")
    whole = x == F.floor(x)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).when(whole, x.cast("bigint").cast("string")).otherwise(F.format_string("%.6f", x))


def tolerance(answer: Column | str, mode: Column | str) -> Column:
    """The larger of fixed minutes and a share of the answer, by mode."""
    out = F.lit(None).cast("double")
    for name, (minutes, share) in TOLERANCE.items():
        out = F.when(col(mode) == name, F.greatest(F.lit(minutes), col(answer) * share)).otherwise(out)
    return out


def variation_percent(estimate: Column | str, moe: Column | str) -> Column:
    return F.when(col(estimate) != 0, col(moe) / MOE_DIVISOR / col(estimate) * 100)


def reliability_tier(estimate: Column | str, moe: Column | str) -> Column:
    """1, 2 or 3 by the coefficient of variation; null where it's unknown or the estimate is 0."""
    cv = variation_percent(estimate, moe)
    low, high = TIER_EDGES
    return F.when(cv <= low, 1).when(cv <= high, 2).when(cv.isNotNull(), 3).cast("bigint")


def reliability_action(tier: Column | str) -> Column:
    return F.when(col(tier) == 3, "interval-only").otherwise("publish")


def censored(c: Column | str, cap: float) -> Column:
    """Missing and larger values become the cap."""
    return F.least(F.coalesce(col(c), F.lit(cap)), F.lit(cap))


def rounded(c: Column, digits: int) -> Column:
    """What F.round gives, without decimal arithmetic except where a value is close to a tie, too large or no number."""
    scaled, one = c * F.lit(float(10**digits)), F.lit(float(10**digits))
    plain = (F.abs(scaled - F.rint(scaled)) < 0.49999) & (F.abs(scaled) < 1e9)
    return F.when(plain, F.rint(scaled) / one + 0.0).otherwise(F.round(c, digits))


def snapshot_parts(c: Column | str) -> tuple[Column, Column]:
    """Date and number of a snapshot id YYYY-MM-DD[-N], N from 1 without padding; nulls for anything else."""
    shape = r"^(\d{4}-\d{2}-\d{2})(-([1-9]\d*))?$"
    day = F.when(col(c).rlike(shape), F.try_to_date(F.regexp_extract(col(c), shape, 1), "yyyy-MM-dd"))
    number = F.coalesce(F.nullif(F.regexp_extract(col(c), shape, 3), F.lit("")).cast("int"), F.lit(0))
    return day, F.when(day.isNotNull(), number)


def allowed_url(url: Column | str, domains: tuple[str, ...]) -> Column:
    """https, host equal to or under an allowed domain, no credentials, no number for a host."""
    part = lambda name: F.try_parse_url(col(url), F.lit(name))
    host = F.lower(part("HOST"))
    under = F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: (host == d) | host.endswith(F.concat(F.lit("."), d)))
    return F.coalesce((part("PROTOCOL") == "https") & part("USERINFO").isNull() & under & ~host.rlike(r"^[0-9.]+$"), F.lit(False))


def class_of(value: Column | str, edges: Column) -> Column:
    """1-based class of (e[i-1], e[i]], the first closed on the left, clipped to the classes; null stays null."""
    below = F.size(F.filter(edges, lambda e: e < col(value)))
    return F.when(col(value).isNotNull(), F.greatest(F.lit(1), F.least(F.greatest(F.size(edges) - 1, F.lit(1)), below))).cast("int")


def scrubbed(c: Column | str, roots: dict[str, str]) -> Column:
    """Known root paths become placeholders, the longest root first."""
    return reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), sorted(roots.items(), key=lambda kv: (-len(kv[0]), kv[0])), col(c))


def slug(c: Column | str) -> Column:
    """Lower case, other characters as single hyphens, one hyphen taken off either end."""
    folded = F.translate(F.lower(col(c)), "àáâäçèéêëìíîïñòóôöùúûüß", "aaaaceeeeiiiinoooouuuus")
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "-"), "^-|-$", "")


def url_escaped(c: Column | str) -> Column:
    return reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), ((" ", "%20"), ("|", "%7C"), ("*", "%2A"), ("<", "%3C"), (">", "%3E")), col(c))


def strict_number(c: Column | str) -> Column:
    """The number that a text is; any other text fails the job."""
    return col(c).cast("double")


def bare_name(c: Column | str) -> Column:
    """Whether a name of a file is one, and not a path."""
    return F.coalesce((col(c) != "") & ~col(c).isin(".", "..", "manifest.json") & ~col(c).rlike(r"[/\\\\:]") & ~col(c).rlike(r"^(\.\.|~)"), F.lit(False))


def web_address(c: Column | str) -> Column:
    """Whether a text is an address by http or https with a host and without credentials."""
    part = lambda name: F.try_parse_url(col(c), F.lit(name))
    return F.coalesce(part("PROTOCOL").isin("http", "https") & (part("HOST") != "") & part("USERINFO").isNull(), F.lit(False))


def manifest_faults(source: Column, snapshot: Column, acquired_at: Column, urls: list[Column], bucket: Column, version: Column, files: Column, terms: Column) -> Column:
    """What is wrong with a manifest, rule by rule: files maps names to digests; the second address may be null; version is a whole number."""
    day, _ = snapshot_parts(snapshot)
    names, digests = F.map_keys(files), F.map_values(files)
    utc = F.coalesce(acquired_at.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]00:00)$") & F.try_to_timestamp(F.regexp_replace(F.substring(acquired_at, 1, 16), "T", " "), F.lit("yyyy-MM-dd HH:mm")).isNotNull(), F.lit(False))
    rules = {
        "source": F.coalesce(source.rlike(SLUG), F.lit(False)),
        "snapshot": day.isNotNull(),
        "acquired_at": utc,
        "url": web_address(urls[0]),
        "second url": F.when(urls[1].isNull(), True).otherwise(web_address(urls[1])),
        "bucket": F.coalesce(bucket.isin("A", "B"), F.lit(False)),
        "version": F.coalesce(version >= 1, F.lit(False)),
        "files": F.coalesce(F.size(files) > 0, F.lit(False)),
        "file name": ~F.coalesce(F.exists(names, lambda n: ~bare_name(n)), F.lit(False)),
        "digest": ~F.coalesce(F.exists(digests, lambda x: ~F.coalesce(x.rlike("^[0-9a-f]{64}$"), F.lit(False))), F.lit(False)),
        "terms": F.coalesce(bare_name(terms) & F.array_contains(names, terms), F.lit(False)),
    }
    return F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
