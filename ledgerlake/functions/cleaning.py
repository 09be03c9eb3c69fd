"""Text → value parsing policies of the raw exports (all JVM-side Column expressions).

Raw business columns are text.  The reference deliberately applies several
*different* policies to them; each is one function here, so a job states the
policy it uses:

* ``clean_text``     remove tabs, trim spaces, blank → null
* ``trim_null``      trim spaces, blank → null (tabs kept)
* ``num_strict``     blank → null, anything unparsable raises (ANSI cast)
* ``num_or_null``    only ``-?digits(.digits*)?`` parses, else null
* ``num_or_zero``    same gate, else 0
* ``num_dash_null``  ``'-'`` → null, then strict
* ``num_grouped``    strip thousands commas; blank / ``--`` → 0; else strict
* ``num_grouped_null`` strip commas; blank, ``-``, ``--``, junk → null
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Working decimal type for parsed money / quantities and the output type.
NUM = DecimalType(18, 4)
MONEY = DecimalType(18, 2)

# Fixed values of the reference's rules (status texts, platform names).
CANCELLED = "已取消"            # order cancelled
FIN_CANCELLED = "订单取消"      # finance bill of a cancelled order
FULL_REFUND = "全部退款"        # fully refunded
UNMATCHED = "未匹配"            # store not matched to the dimension
DIRECT_STORE = "直营"           # directly operated store
PLATFORM_MT = "美团"
PLATFORM_EL = "饿了么"
PLATFORM_JD = "京东"

# Lenient number gate: optional minus, digits, optional fraction.  ``\z`` (not
# ``$``) so that a trailing newline does not pass.
NUM_GATE = r"^-?[0-9]+(\.[0-9]*)?\z"
# Bracket pair: the store short name is the text inside the last pair.
PAREN_ANY = r"(?s)[（(].+?[）)]"
PAREN_LAST = r"(?s).*[（(](.+?)[）)].*"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x) -> Column:
    """``NULLIF(TRIM(REPLACE(x, TAB, '')), '')``."""
    return F.nullif(F.trim(F.replace(_c(x), F.lit("\t"), F.lit(""))), F.lit(""))


def trim_null(x) -> Column:
    """``NULLIF(TRIM(x), '')`` — tabs are kept."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def num_strict(x, dtype=NUM) -> Column:
    """Blank → null, junk raises (ANSI cast)."""
    return trim_null(x).cast(dtype)


def _gated(x, otherwise, dtype=NUM, strip_tabs=False) -> Column:
    t = F.trim(F.replace(_c(x), F.lit("\t"), F.lit(""))) if strip_tabs else F.trim(_c(x))
    return F.when(t.rlike(NUM_GATE), t.cast(dtype)).otherwise(otherwise)


def num_or_null(x, dtype=NUM, strip_tabs=False) -> Column:
    """Regex-gated number, anything else null."""
    return _gated(x, F.lit(None).cast(dtype), dtype, strip_tabs)


def num_or_zero(x, dtype=NUM, strip_tabs=False) -> Column:
    """Regex-gated number, anything else 0 (used inside sums)."""
    return _gated(x, F.lit(0).cast(dtype), dtype, strip_tabs)


def num_dash_null(x, dtype=NUM) -> Column:
    """``NULLIF(NULLIF(TRIM(x), ''), '-')`` then strict cast."""
    return F.nullif(trim_null(x), F.lit("-")).cast(dtype)


def num_grouped(x, dtype=NUM) -> Column:
    """Thousands commas removed; null, blank, ``--`` → 0; junk raises."""
    t = F.trim(F.replace(_c(x), F.lit(","), F.lit("")))
    return (F.when(_c(x).isNull() | t.isin("", "--"), F.lit(0).cast(dtype))
            .otherwise(t.cast(dtype)))


def num_grouped_null(x) -> Column:
    """Thousands commas removed; blank, ``-``, ``--``, junk → null (double)."""
    t = F.trim(F.replace(_c(x), F.lit(","), F.lit("")))
    return F.when(t.isin("", "-", "--"), F.lit(None).cast("double")).otherwise(
        t.try_cast("double"))


PLAIN_INTEGER = r"\A\+?(-?)0*([0-9]+)(?:\.0*)?\z"


def norm_code(x) -> Column:
    """Code text: tabs removed, trimmed; ``-``/blank → ''; integral number text
    (``123.0``, ``1e3``) → integer text; anything else unchanged.

    Digits are normalised as text, at any length; only other number forms
    (an exponent, no digit before the point) are computed, exactly, up to 32
    digits."""
    t = F.trim(F.replace(_c(x), F.lit("\t"), F.lit("")))
    digits = F.concat(F.regexp_extract(t, PLAIN_INTEGER, 1), F.regexp_extract(t, PLAIN_INTEGER, 2))
    d = t.try_cast("decimal(38,6)")
    return (F.when(_c(x).isNull() | t.isin("", "-"), F.lit(""))
            .when(t.rlike(PLAIN_INTEGER), F.when(digits == "-0", F.lit("0")).otherwise(digits))
            .when(d.isNotNull() & (d == F.floor(d)), F.floor(d).cast("decimal(38,0)").cast("string"))
            .otherwise(t))


def paren_extract(x) -> Column:
    """Store short name: text in the last bracket pair (full or half width)."""
    c = _c(x)
    return F.when(c.rlike(PAREN_ANY), F.regexp_replace(c, PAREN_LAST, "$1")).otherwise(c)


def paren_normalize(x) -> Column:
    """Full-width brackets → half-width (for name comparison)."""
    return F.translate(_c(x), "（）", "()")


def map_values(x, mapping: dict[str, str]) -> Column:
    """CASE x WHEN k THEN v ... ELSE x END."""
    c = _c(x)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return c if expr is None else expr.otherwise(c)


def first_non_blank(*cols, default=None) -> Column:
    """COALESCE(NULLIF(a, ''), b, ..., default)."""
    parts = [F.nullif(_c(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def date_strict(x) -> Column:
    """``NULLIF(TRIM(x), '')::date`` — junk raises."""
    return trim_null(x).cast("date")


def date_fmt(x) -> Column:
    """``to_date(x, 'YYYY-MM-DD')`` tolerating trailing text (time part)."""
    return F.to_date(F.substring(trim_null(x), 1, 10), "yyyy-MM-dd")


def date_lenient(x) -> Column:
    """``YYYY-MM-DD`` or ``YYYY-M-D``; anything else null."""
    return trim_null(x).try_cast("date")


def ts_fmt(x) -> Column:
    """``to_timestamp(x, 'YYYY-MM-DD HH24:MI:SS')`` as wall-clock time."""
    t = trim_null(x)
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")),
                      t.try_cast("timestamp_ntz")).cast("timestamp_ntz")


def cn_day_text(d) -> Column:
    """Date → ``YYYY年MM月DD日`` prefix text."""
    return F.date_format(_c(d), "yyyy'年'MM'月'dd'日'")


def day_text(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def money(x) -> Column:
    """Rounding cast to cents."""
    return _c(x).cast(MONEY)


def safe_ratio(a, b) -> Column:
    """``COALESCE(a / NULLIF(b, 0), 1)``."""
    return F.coalesce(_c(a) / F.nullif(_c(b), F.lit(0)), F.lit(1))


def guarded_div(x, n, otherwise=0) -> Column:
    """``CASE WHEN n > 0 THEN x / n ELSE otherwise END``."""
    o = F.lit(otherwise) if otherwise is not None else F.lit(None)
    return F.when(_c(n) > 0, _c(x) / _c(n)).otherwise(o)


def refund_clamp(is_cancelled, amount) -> Column:
    """Cancelled / fully refunded rows: positive → 0, negative kept, null → 0;
    normal rows unchanged."""
    f, v = _c(is_cancelled), _c(amount)
    zero = F.lit(0).cast(NUM)
    return F.when(~f, v).when(v > 0, zero).when(v < 0, v).otherwise(zero)


def typed_null(dtype) -> Column:
    return F.lit(None).cast(dtype)
