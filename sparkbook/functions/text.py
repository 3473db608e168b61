"""String decoding, absence conventions, identifier formats and tagging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers publishers use for an absent value.
MISSING_MARKERS = ("", "N/A")

# Identifier formats (ISIN, LEI, MIC) of the register schema,
# plus the ISO currency-code and ISO date shapes of the rate file.
PATTERNS = {
    "ISIN": r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$",
    "LEI": r"^[A-Z0-9]{18}[0-9]{2}$",
    "MIC": r"^[A-Z0-9]{4}$",
    "CURRENCY": r"^[A-Z]{3}$",
    "DATE": r"^\d{4}-\d{2}-\d{2}$",
}

# Keyword -> symbol rules for crypto-linked instrument names
# (first keyword wins) and the tokens that exclude leveraged/inverse wrappers.
CRYPTO_KEYWORDS = [
    ("BITCOIN", "BTC"), ("XBT", "BTC"), ("ETHEREUM", "ETH"), ("ETHER ", "ETH"),
    ("SOLANA", "SOL"), ("CARDANO", "ADA"), ("POLKADOT", "DOT"),
    ("LITECOIN", "LTC"), ("RIPPLE", "XRP"), ("CHAINLINK", "LINK"),
    ("AVALANCHE", "AVAX"), ("POLYGON", "MATIC"),
]
CRYPTO_EXCLUDE_TOKENS = ["2X", "3X", "-1X", "SHORT", "INVERSE", "LEVERAG", "BEAR"]

# CFI category letter -> asset class of the instrument dimension.
CFI_ASSET_CLASS = [("C", "collective_investment"), ("D", "debt"), ("E", "equity")]

# How a classification code and a nominal per unit name the asset
# class; the first rule whose prefix and least nominal hold decides.
ASSET_RULES = [
    ("C", None, "fund"),
    ("D", 100.0, "bond"),
    ("D", None, "structured"),
    ("ES", None, "equity"),
    ("E", None, "certificate"),
]
# Classes quoted in percent of par, and their dealing size where
# the register's nominal is below the par rule.
PAR_CLASSES = ("bond",)
PAR_DEALING_SIZE = 1000.0


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_empty(c: str | Column) -> Column:
    return F.nullif(_c(c), F.lit(""))


def is_blank(c: str | Column) -> Column:
    """Absent: null, '' or 'N/A'."""
    col = _c(c)
    return col.isNull() | col.isin(*MISSING_MARKERS)


def default_if_blank(c: str | Column, default: str) -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(_c(c))


def to_bool(c: str | Column) -> Column:
    """'true' -> true, anything else false, null stays null (3-valued)."""
    return _c(c) == F.lit("true")


def to_flag(c: str | Column) -> Column:
    """Same decode with null coalesced to false."""
    return F.coalesce(to_bool(c), F.lit(False))


def bad_format(c: str | Column, kind: str, allow_blank: bool = True) -> Column:
    """True where a present value does not match the identifier format."""
    col = _c(c)
    miss = ~F.coalesce(col.rlike(PATTERNS[kind]), F.lit(False))
    return (~is_blank(col) & miss) if allow_blank else miss


def cfi_category(cfi: str | Column) -> Column:
    """First letter of the CFI code; null when the code is blank."""
    return F.when(is_blank(cfi), F.lit(None).cast("string")).otherwise(F.substring(_c(cfi), 1, 1))


def cfi_asset_class(category: str | Column) -> Column:
    out = F.lit(None).cast("string")
    for letter, cls in reversed(CFI_ASSET_CLASS):
        out = F.when(_c(category) == letter, F.lit(cls)).otherwise(out)
    return out


def asset_class(cfi: str | Column, nominal: str | Column) -> Column:
    """Class by ASSET_RULES; null where no rule holds."""
    def holds(prefix: str, least: float | None) -> Column:
        fits = _c(cfi).startswith(prefix)
        return fits if least is None else fits & (_c(nominal) >= least)

    return F.coalesce(*[F.when(holds(prefix, least), cls) for prefix, least, cls in ASSET_RULES])


def price_convention(cls: str | Column) -> Column:
    """'percent_of_par' or 'per_unit' by class, null without one."""
    return F.when(_c(cls).isNotNull(), F.when(_c(cls).isin(*PAR_CLASSES), "percent_of_par").otherwise("per_unit"))


def nominal_step(nominal: str | Column, convention: str | Column) -> Column:
    """What an order must be a multiple of: whole units, or the nominal a par-quoted line is issued in."""
    least = next(least for _, least, cls in ASSET_RULES if cls in PAR_CLASSES)
    issued = _c(nominal).cast("double")
    usable = F.when(issued >= least, issued)
    return F.when(_c(convention) == "percent_of_par", F.coalesce(usable, F.lit(PAR_DEALING_SIZE))).otherwise(1.0)


def safe_double(c: str | Column, default: float = 0.0) -> Column:
    """Tolerant float parse with a default for blank or garbage."""
    return F.coalesce(F.when(~is_blank(c), _c(c)).try_cast("double"), F.lit(default))


def keyword_tag(
    name: str | Column,
    rules: Sequence[tuple[str, str]] = tuple(CRYPTO_KEYWORDS),
    excludes: Sequence[str] = tuple(CRYPTO_EXCLUDE_TOKENS),
) -> Column:
    """Symbol of the first keyword found in the upper-cased name; '' when an
    exclusion token is present or nothing matches."""
    up = F.upper(_c(name))
    out = F.lit("")
    for kw, sym in reversed(list(rules)):
        out = F.when(up.contains(kw), F.lit(sym)).otherwise(out)
    excluded = F.lit(False)
    for tok in excludes:
        excluded = excluded | up.contains(tok)
    return F.when(excluded, F.lit("")).otherwise(out)
