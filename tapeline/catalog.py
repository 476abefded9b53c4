"""What is loaded and what is exported: table and export specifications, and the fields that follow from a schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_EOD = ("ts_code", "trade_date")


@dataclass(frozen=True)
class TableSpec:
    """A landed table. ``key`` empty: keyless. ``replace_key``: rows of the batch's keys are replaced together."""

    name: str
    key: tuple[str, ...] = ()
    date_col: str | None = None
    strategy: str = "once"
    replace_key: str | None = None
    keep_null_key: bool = False


@dataclass(frozen=True)
class ExportSpec:
    """How a table becomes features. ``naming``: standard, adjusted, factor, aggregated or encoded."""

    table: str
    inst_type: str
    date_col: str = "trade_date"
    inst_col: str | None = "ts_code"
    naming: str = "standard"
    prefix: str | None = None
    agg: str | None = None
    type_col: str | None = None
    weights: dict[str, str] = field(default_factory=dict)
    count_name: str | None = None
    raw_fields: bool = True
    computed: tuple[tuple[str, ...], ...] = ()
    virtual: str | None = None
    predicate: str | None = None


@dataclass(frozen=True)
class FieldDef:
    """An exported field: a source column, or a computation named by ``computed`` on ``column``."""

    name: str
    column: str | None = None
    computed: str | None = None
    weight: str | None = None


def _dated(*names: str) -> list[TableSpec]:
    return [TableSpec(n, _EOD, "trade_date", "trade_date") for n in names]


# The landed tables. Event tables with several rows a day have no key; a batch replaces its days or codes.
TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("trade_cal", ("exchange", "cal_date")), TableSpec("etf_basic", ("ts_code",)), TableSpec("cb_basic", ("ts_code",)),
    TableSpec("stock_basic", ("ts_code",)), TableSpec("index_basic", ("ts_code",)), TableSpec("index_classify", ("index_code",)),
    TableSpec("ci_index_member", ("ts_code",)), TableSpec("index_member_all", ("ts_code",)), TableSpec("hm_list"), TableSpec("gz_index", ("date",), "date"),
    TableSpec("index_weight", ("index_code", "con_code", "trade_date"), "trade_date", "domain"), TableSpec("margin", ("exchange_id", "trade_date"), "trade_date", "trade_date"),
    TableSpec("moneyflow_hsgt", ("trade_date",), "trade_date", "trade_date"), TableSpec("dividend", ("ts_code", "ann_date", "div_proc"), "ann_date", "domain", keep_null_key=True),
    TableSpec("stk_holdernumber", (), "ann_date", "domain", replace_key="ts_code"), TableSpec("stk_holdertrade", (), "ann_date", "domain", replace_key="ts_code"),
    TableSpec("repurchase", (), "ann_date", "trade_date", replace_key="ann_date"), TableSpec("block_trade", (), "trade_date", "trade_date", replace_key="trade_date"),
    TableSpec("top_inst", (), "trade_date", "trade_date", replace_key="trade_date"), TableSpec("kpl_concept_cons", (), "trade_date", "trade_date", replace_key="trade_date"),
    *_dated("fund_adj", "cb_factor_pro", "fund_factor_pro", "daily_info", "sz_daily_info", "index_dailybasic", "idx_factor_pro", "sw_daily", "margin_detail", "stock_hsgt", "stock_st"),
    *_dated("bak_basic", "limit_list_d", "kpl_list", "top_list", "cyq_perf", "stk_factor_pro", "bak_daily", "stk_limit", "moneyflow", "moneyflow_dc"),
]}

# The exported tables.
EXPORTS: dict[str, ExportSpec] = {e.table: e for e in [
    ExportSpec("stk_factor_pro", "stock", naming="adjusted", computed=(("vwap", "vwap"),)),
    ExportSpec("bak_daily", "stock", prefix="bd"), ExportSpec("bak_basic", "stock", prefix="bb"), ExportSpec("moneyflow", "stock", prefix="mf"),
    ExportSpec("moneyflow_dc", "stock", prefix="mdc"), ExportSpec("margin_detail", "stock", prefix="md"),
    ExportSpec("stock_hsgt", "stock", naming="aggregated", agg="split_by_type", type_col="type", computed=(("hsgt_sh", "type_SH"), ("hsgt_sz", "type_SZ"), ("hsgt_cnt", "count"))),
    ExportSpec("stk_limit", "stock", prefix="sl"), ExportSpec("limit_list_d", "stock", prefix="lld"), ExportSpec("cyq_perf", "stock", prefix="cyq"),
    ExportSpec("stk_holdernumber", "stock", "ann_date", prefix="shn"),
    ExportSpec("stk_holdertrade", "stock", "ann_date", naming="aggregated", prefix="sht", agg="sum_count", count_name="sht_trade_cnt", weights={"avg_price": "change_vol"}),
    ExportSpec("pledge_detail", "stock", "ann_date", naming="aggregated", prefix="pd", agg="sum_count", count_name="pd_pledge_cnt"),
    ExportSpec("repurchase", "stock", "ann_date", naming="aggregated", prefix="rp", agg="sum_count", count_name="rp_cnt"),
    ExportSpec("block_trade", "stock", naming="aggregated", prefix="bt", agg="sum_count", count_name="bt_trade_cnt", weights={"price": "vol"}),
    ExportSpec("top_list", "stock", prefix="tl"), ExportSpec("top_inst", "stock", naming="aggregated", prefix="ti", agg="sum_count", count_name="ti_inst_cnt"),
    ExportSpec("kpl_list", "stock", prefix="kpl"),
    ExportSpec("kpl_concept_cons", "stock", naming="aggregated", agg="count", count_name="kcc_concept_cnt", raw_fields=False, computed=(("kcc_hot_num_total", "sum", "hot_num"),)),
    ExportSpec("stock_st", "stock", naming="encoded", type_col="type", computed=(("st_is_st", "is_st"),)),
    ExportSpec("idx_factor_pro", "index", naming="factor", prefix="idx", computed=(("vwap", "vwap"),)),
    ExportSpec("index_dailybasic", "index", prefix="idb"), ExportSpec("daily_info", "index", prefix="di"), ExportSpec("sz_daily_info", "index", prefix="sdi"),
    ExportSpec("sw_daily", "sw_sector", prefix="sw"), ExportSpec("fund_factor_pro", "etf", naming="factor", prefix="etf", computed=(("vwap", "vwap"),)),
    ExportSpec("fund_adj", "etf", prefix="fa"), ExportSpec("cb_factor_pro", "cb", naming="factor", prefix="cb", computed=(("vwap", "vwap"),)),
    ExportSpec("gz_index", "market", "date", None, prefix="gz", virtual="_market_gz"),
    ExportSpec("margin", "market", inst_col="exchange_id", prefix="mg", virtual="_market_margin", predicate="exchange_id = 'SSE'"),
    ExportSpec("moneyflow_hsgt", "market", inst_col=None, prefix="hsgtflow", virtual="_market_hsgt"),
]}

# Price and volume columns, and the valuation columns that an adjusted table exports under their own names.
PRICE_COLUMNS = ("open", "high", "low", "close", "pre_close", "change", "pct_chg", "pct_change", "vol", "amount")
VALUATION = ("pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm", "total_share", "float_share", "free_share", "total_mv", "circ_mv", "turnover_rate", "turnover_rate_f", "volume_ratio")


def numeric_columns(schema: T.StructType) -> list[str]:
    return sorted(f.name for f in schema.fields if isinstance(f.dataType, T.NumericType))


def derive_fields(spec: ExportSpec, schema: T.StructType) -> list[FieldDef]:
    """The fields that a table with ``schema`` exports under ``spec``: a new numeric column is a new field."""
    columns = numeric_columns(schema)
    have = set(columns)
    renamed = {"vol": "volume"}
    out: list[FieldDef] = []
    if spec.naming == "adjusted":
        prices = {f"{c}_hfq": c for c in PRICE_COLUMNS[:4]}
        named = prices | {c: c for c in ("pre_close", "change", "pct_chg")} | {"vol": "volume", "amount": "amount", "adj_factor": "factor"} | {c: c for c in sorted(VALUATION)}
        named |= {c: c.replace("_hfq", "") for c in columns if "_hfq" in c and c not in prices}
        out = [FieldDef(name, c) for c, name in named.items() if c in have]
    elif spec.naming == "factor":
        own = [c for c in columns if c in PRICE_COLUMNS]
        out = [FieldDef(renamed.get(c, c), c) for c in own] + [FieldDef(f"{spec.prefix}_{c.removesuffix('_bfq')}", c) for c in columns if c not in PRICE_COLUMNS]
    elif spec.naming != "encoded" and spec.raw_fields and spec.agg != "split_by_type":
        out = [FieldDef(f"{spec.prefix}_{c}" if spec.prefix else c, c, weight=spec.weights.get(c)) for c in columns]
    if spec.naming == "aggregated" and spec.count_name:
        out.append(FieldDef(spec.count_name, computed="count"))
    return out + [FieldDef(c[0], c[2] if len(c) > 2 else None, c[1]) for c in spec.computed]


def depends_on(spec: ExportSpec, fields: list[FieldDef]) -> list[str]:
    """The source columns that a choice of fields reads, besides instrument and date."""
    out = [c for f in fields for c in (f.column, f.weight) if c]
    out += [c for f in fields if f.computed == "vwap" for c in ("amount", "vol")]
    if spec.type_col and any(f.computed for f in fields):
        out.append(spec.type_col)
    return list(dict.fromkeys(out))
