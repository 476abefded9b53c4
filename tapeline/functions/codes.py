"""Codes, flags, labels and arithmetic of single rows. All are built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The defaults of an open listing range, of which exchanges a suffix is known, and how a share-link type is read.
RANGE_START, RANGE_END = "1990-01-01", "2099-12-31"
EXCHANGES = ("SZ", "SH", "BJ")
LINK_TYPES = {"HK_SH": "SH", "HK_SZ": "SZ", "1": "SH", "2": "SZ"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instrument(code: Column | str, kind: str = "stock") -> Column:
    """``000001.SZ`` as ``SZ000001``. Sectors, and codes without exactly one dot, are only upper-cased; market codes stay."""
    c = _col(code)
    if kind == "market":
        return c
    parts = F.split(c, r"\.")
    return F.upper(c) if kind == "sw_sector" else F.when(F.size(parts) == 2, F.upper(F.concat(parts[1], parts[0]))).otherwise(F.upper(c))


def source_code(inst: Column | str, kind: str = "stock") -> Column:
    """``SZ000001`` as ``000001.SZ``. Names that begin with ``_`` stay; sectors are upper-cased. Only for two-letter exchanges:
    tables that have the source code as a column should use that."""
    c = _col(inst)
    if kind == "sw_sector":
        return F.upper(c)
    return F.when(c.startswith("_"), c).otherwise(F.concat(F.substring(c, 3, 1_000), F.lit("."), F.upper(F.substring(c, 1, 2))))


def listed_suffix(code: Column | str) -> Column:
    """Whether a code ends in a known exchange, in any case."""
    return _col(code).rlike(rf"(?i)\.({'|'.join(EXCHANGES)})$")


def present(c: Column | str) -> Column:
    """Neither null nor blank."""
    return _col(c).isNotNull() & (_col(c) != "")


def number(c: Column | str) -> Column:
    """A double; text that isn't a number is null."""
    return _col(c).try_cast("double")


def st_flag(kind: Column | str) -> Column:
    """1 if the type holds an S in any case, else 0."""
    return F.when(F.upper(F.coalesce(_col(kind), F.lit(""))).contains("S"), 1).otherwise(0)


def link_type(c: Column | str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in LINK_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, _col(c)), _col(c))


def vwap(amount: Column | str, vol: Column | str) -> Column:
    """Price from an amount in thousands and a volume in hundreds, in single precision; null unless the volume is positive."""
    a, v = _col(amount).cast("float"), _col(vol).cast("float")
    return F.when((v > 0) & a.isNotNull(), (a * F.lit(10.0).cast("float") / v).cast("float"))


def tier(percent: Column | str) -> Column:
    """How complete a table is."""
    return F.when(_col(percent) >= 99.9, "perfect").when(_col(percent) >= 95, "small_gap").otherwise("big_gap")


def emptiness(rows: Column, log_rows: Column) -> Column:
    """Why a table has no row: never loaded, or loaded without a result."""
    return F.when(rows > 0, F.lit(None).cast("string")).when(log_rows == 0, "untouched").otherwise("empty")


def listed_range(start: Column, end: Column) -> tuple[Column, Column]:
    """A listing range with the defaults for what is missing."""
    return F.coalesce(start, F.lit(RANGE_START).cast("date")), F.coalesce(end, F.lit(RANGE_END).cast("date"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def percent_text(c: Column | str) -> Column:
    return F.format_string("%.1f%%", _col(c))


def batch_id(params: Column) -> Column:
    """16 hex digits that name a landed payload by its request; ``params`` is a struct in the order of its field names."""
    return F.upper(F.substring(F.sha2(F.to_json(params), 256), 1, 16))


# Field categories in the order in which they are tried, and what in a field's name points to each.
CATEGORY_ENDINGS = ("open", "high", "low", "close", "volume", "amount", "vwap", "pre_close", "change", "pct_chg", "pct_change")
CATEGORY_PARTS = (
    ("valuation", ("pe", "pb", "ps", "mv", "total_share", "float_share", "free_share", "dv_ratio", "dv_ttm", "adj_factor")),
    ("liquidity", ("turnover", "volume_ratio")),
    ("moneyflow", ("buy_", "sell_", "net_mf", "net_amount")),
    ("margin", ("rzye", "rqye", "rzmre", "rzche", "rqmcl", "rzrqye", "rqyl", "rqchl")),
    ("chip", ("cyq_", "winner", "cost_")),
    ("event", ("limit", "st_is_st", "pledge", "repurchase", "block_trade", "hsgt", "kpl_", "top_list", "top_inst", "holder")),
)
MACRO_TABLES = ("gz_index", "moneyflow_hsgt")
FUNDAMENTAL_PARTS = ("eps", "bvps", "gpr", "npr", "rev_yoy", "profit_yoy", "total_assets", "liquid_assets", "fixed_assets", "reserved", "undp", "holder_num")


def category(field: Column | str, table: Column | str) -> Column:
    """The category of an exported field from its name and table."""
    name = F.lower(_col(field))
    any_part = lambda parts: reduce(lambda a, b: a | b, [name.contains(p) for p in parts])
    out = F.when(reduce(lambda a, b: a | b, [name.endswith(p) for p in CATEGORY_ENDINGS]), "OHLCV")
    for label, parts in CATEGORY_PARTS:
        out = out.when(any_part(parts), label)
    return out.when(_col(table).isin(*MACRO_TABLES), "macro").when(any_part(FUNDAMENTAL_PARTS), "fundamental").otherwise("technical")


def applies_to(kind: Column | str) -> Column:
    """The instrument type in words."""
    return F.when(_col(kind) == "cb", "convertible_bond").when(_col(kind) == "market", "market_virtual").otherwise(_col(kind))


def adjustment(kind: Column | str, table: Column | str) -> Column:
    """Which price adjustment a table's fields carry."""
    return F.when((_col(kind) == "stock") & (_col(table) == "stk_factor_pro"), "hfq").when((_col(kind) == "cb") & (_col(table) == "cb_factor_pro"), "bfq").otherwise("none")


def any_of(df: DataFrame, filters: dict[str, list]) -> DataFrame:
    """Rows whose columns have one of the values asked for, in all of ``filters``."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]).isin(kv[1])), filters.items(), df)
