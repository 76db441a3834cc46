"""Order backlog: one row per order line with delivered, lost and open quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import code_label, day_text, joined_text, open_balance, to_other_currency
from ledgerloom.operators.joins import has_match, latest_by, lookup, totals_by
from ledgerloom.operators.lists import counted_values, list_text
from ledgerloom.operators.stages import Keys, rows_of, staged, staged_keys
from ledgerloom.plans import codes
from ledgerloom.sources.erp import Tables

# The columns of the dataset, in order.
COLUMNS = """
codi_emp desc_mun pedi_ped seri_ped demi_ped codi_tra cgc_tra raza_tra prop_pro desc_pro codi_cic desc_cic cond_con
desc_con codi_pes nome_pes codi_top desc_top ccfo_cfo desc_cfo vcto_ped venc_pfp codi_ind desc_ind vlor_vlr tota_ped
tota_om_ped codi_psv desc_psv codi_gpr desc_gpr codi_sbg desc_sbg cod_fabricante fabricante qtde_pedida qtde_entregue
qtde_perdida saldo qtde_pedida_om qtde_entregue_om qtde_perdida_om saldo_om vlr_unit vlr_unit_om total_item
total_item_om cust_tab cust_tab_om tabe_cta desc_cta usu_inclusao custo_compra principio_ativo unidade moeda_rt rt
cotacao_dolar ult_compra pedido_origem numero_negociacao tipo_negociacao rt_liquida cotacao_dolar_negociacao
contrato_barter venda_perdida_real
""".split()

_ORDER = {"codi_emp": "codi_emp", "pedi_ped": "pedi_ped", "seri_ped": "seri_ped"}
_LINE = {**_ORDER, "codi_psv": "codi_psv"}


# The sums below are built for the given orders only; their notes and losses may be of any day.
_OF_NOTE = {"empr_ped": "codi_emp", "pedi_ped": "pedi_ped", "seri_ped": "seri_ped"}
_BY_ORDER = {k: k for k in _ORDER}


def delivered(t: Tables, orders: Keys) -> DataFrame:
    """Returned and delivered quantities per order line, from notes that are not cancelled."""
    shown = ["npre_not", *_OF_NOTE, "codi_psv", "qdev_ino", "qent_ino"]
    lines = staged(rows_of(t["inota"].select(*shown), orders, _OF_NOTE), "delivered_lines")
    notes = rows_of(t["nota"].where("situ_not <> '9'"), staged_keys(lines, ["npre_not"], "delivered_keys"), {"npre_not": "npre_not"})
    zero = F.lit(0)
    return totals_by(
        lookup(lines, notes, {"npre_not": "npre_not"}, {}, "inner"),
        ["pedi_ped", "seri_ped", "codi_psv", "empr_ped"],
        qdev=F.sum(F.coalesce("qdev_ino", zero)), qent=F.sum(F.coalesce("qent_ino", zero)),
    )


def sent_by_order(t: Tables, orders: Keys) -> DataFrame:
    """Quantity the order's own delivery flow reports per order line.

    The source computes it in a table function whose body is not part of the reports; its result
    is taken as an input table and summed to one row per order line.
    """
    return totals_by(rows_of(t["qtde_entr_ped_ven"], orders, _BY_ORDER), list(_LINE), sent=F.sum("qent"))


def lost_sales(t: Tables, orders: Keys) -> DataFrame:
    """Lost quantity per order line; reasons that are unknown or no real loss do not count."""
    real = t["ocorrencias"].where(~F.col("codi_prv").isin(codes.NOT_LOST))
    return totals_by(rows_of(real, orders, _BY_ORDER), list(_LINE), lost=F.sum("qtde_oco"))


def last_purchase_price(t: Tables, products: Keys | None = None) -> DataFrame:
    """Price of the latest purchase line per product, of all days; of the given products only, if any are given.

    Latest by receipt day, then note number, a missing one first. The source leaves lines of
    one note in any order; here the higher price wins.
    """
    links = {"ctrl_nfe": "ctrl_nfe", "codi_tra": "codi_tra", "seri_nfe": "seri_nfe", "nume_nfe": "nume_nfe",
             "codi_emp": "codi_emp"}
    lines = t["infentra"] if products is None else rows_of(t["infentra"], products, {"codi_psv": "codi_psv"})
    priced = lookup(lines.select(*links, "codi_psv", "vliq_inf"), t["nfentra"], links, {"day": "drec_nfe", "op": "codi_top", "fiscal": "ccfo_cfo"}, "inner")
    bought = lookup(priced, t["funcaotoper"].where(F.col("codi_pto") == codes.PURCHASING), {"op": "codi_top"}, {}, "inner")
    kept = lookup(bought, t["cfo"].where("comp_cfo <> '2'"), {"fiscal": "ccfo_cfo"}, {}, "inner")
    order = ["day", "nume_nfe", "vliq_inf"]
    return latest_by(staged(kept.select("codi_psv", *order), "purchases"), ["codi_psv"], order, price="vliq_inf")


def negotiations(t: Tables) -> DataFrame:
    """Negotiations with their kind as text and the rates that apply to them."""
    kind, currency = F.col("tipo_neg"), F.col("moed_ind")
    in_dollar = (kind == 3) & (currency == "D")
    rated = lookup(
        t["negociacao"], t["indvalor"], {"codi_ind": "codi_ind", "codi_emp": "codi_emp", "data_vlr": "data_vlr"},
        {"rate": "vlor_vlr"},
    )
    return rated.select(
        "ctrl_neg", "codi_pes", "codi_emp", "nume_neg", "vluc_neg", "vlul_neg", "moed_ind", "rate",
        F.when(kind == 1, "REAL").when(kind == 2, "DOLAR").when((kind == 3) & (currency == "R"), "TROCA-REAL")
        .when(in_dollar, "TROCA-DOLAR").alias("kind"),
        F.when(in_dollar, F.col("rate")).alias("dollar_rate"),
    )


def products(t: Tables) -> DataFrame:
    """Products that have a maker entry, with group, subgroup, maker and active ingredient."""
    grouped = lookup(t["prodserv"], t["grupo"], {"codi_gpr": "codi_gpr"}, {"desc_gpr": "desc_gpr"}, "inner")
    split = lookup(grouped, t["subgrupo"], {"codi_sbg": "codi_sbg", "codi_gpr": "codi_gpr"},
                   {"known_sbg": "codi_sbg", "desc_sbg": "desc_sbg"})
    made = lookup(split, t["produto"], {"codi_psv": "codi_psv"}, {"maker": "codi_tra"}, "inner")
    active = lookup(made, t["prinativos"], {"codi_pri": "codi_pri"}, {"active_code": "codi_pri", "active": "desc_pri"})
    return lookup(active, t["transac"], {"maker": "codi_tra"}, {"cod_fabricante": "codi_tra", "fabricante": "raza_tra"})


def orders_of(t: Tables, span: tuple[str, str]) -> DataFrame:
    """Orders of the span that are not cancelled."""
    return t["pedido"].where((F.col("situ_ped") != "9") & F.col("demi_ped").between(*span))


def order_heads(t: Tables, shown: DataFrame, keys: Keys) -> DataFrame:
    """The orders shown with all that follows from their own columns, so no line has to carry it from join to join."""
    control = t["topctrl"].where(F.col("codi_ctr") == codes.DELIVERY_CONTROL)
    orders = has_match(shown, control, {"codi_top": "codi_top"}, "controlled")

    terms = counted_values(rows_of(t["prefinan"], keys, _BY_ORDER), list(_ORDER), "praz_pfp", "terms")
    orders = lookup(orders, terms, _ORDER, {"terms": "terms"})
    orders = orders.withColumn("venc_pfp", list_text("terms", lambda d: day_text(F.date_add("vcto_ped", d)))).drop("terms")

    rates = lookup(t["indvalor"], t["indexador"], {"codi_ind": "codi_ind"}, {"desc_ind": "desc_ind"}, "inner")
    orders = lookup(orders.withColumnRenamed("codi_ind", "index"), rates,
                    {"codi_emp": "codi_emp", "index": "codi_ind", "data_vlr": "data_vlr"},
                    {"codi_ind": "codi_ind", "desc_ind": "desc_ind", "vlor_vlr": "vlor_vlr"})
    orders = lookup(orders, negotiations(t), {"ctrl_neg": "ctrl_neg", "cod1_pes": "codi_pes", "codi_emp": "codi_emp"},
                    {"numero_negociacao": "nume_neg", "tipo_negociacao": "kind", "rt_liquida": "vluc_neg", "rt": "vlul_neg",
                     "moeda": "moed_ind", "cotacao_dolar": "rate", "cotacao_dolar_negociacao": "dollar_rate"})
    orders = staged(orders, "backlog_rated")
    orders = lookup(orders, lookup(t["cademp"], t["municipio"], {"codi_mun": "codi_mun"}, {"desc_mun": "desc_mun"}, "inner"),
                    {"codi_emp": "codi_emp"}, {"desc_mun": "desc_mun"}, "inner")
    orders = lookup(orders, t["transac"], {"codi_tra": "codi_tra"}, {"cgc_tra": "cgc_tra", "raza_tra": "raza_tra"}, "inner")
    # Optional lookups show the code of the looked-up row, so a code without a row is NULL.
    for table, code, text in (
        ("propried", "prop_pro", "desc_pro"), ("ciclo", "codi_cic", "desc_cic"), ("condicao", "cond_con", "desc_con"),
        ("cfo", "ccfo_cfo", "desc_cfo"), ("tipooper", "codi_top", "desc_top"),
    ):
        orders = _with_name(orders, t[table], code, text)
    orders = lookup(orders, t["pessoal"], {"cod1_pes": "codi_pes"}, {"codi_pes": "codi_pes", "nome_pes": "nome_pes"})
    users = lookup(t["cadusu"], t["pessoal"], {"codi_pes": "codi_pes"}, {"nome_pes": "nome_pes"}, "inner")
    return lookup(orders, users, {"codi_usu": "codi_usu"}, {"usu_inclusao": "nome_pes"})


def _with_name(df: DataFrame, table: DataFrame, code: str, text: str) -> DataFrame:
    return lookup(df.withColumnRenamed(code, "_code"), table, {"_code": code}, {code: code, text: text}).drop("_code")


def order_lines(t: Tables, keys: Keys, items: DataFrame) -> DataFrame:
    """Order lines (items) with the sums kept per order line and their price list."""
    lines = items.withColumn("qper_ipe", F.coalesce("qper_ipe", F.lit(0)))
    lines = lookup(lines, sent_by_order(t, keys), _LINE, {"sent": "sent"})
    lines = lookup(lines, lost_sales(t, keys), _LINE, {"lost": "lost"})
    lines = lookup(lines, delivered(t, keys), {"pedi_ped": "pedi_ped", "seri_ped": "seri_ped", "codi_emp": "empr_ped", "codi_psv": "codi_psv"},
                   {"qdev": "qdev", "qent": "qent"})
    return _with_name(lines, t["cabtab"], "tabe_cta", "desc_cta")


def backlog(t: Tables, first_day: str = codes.FIRST_DAY, last_day: str = codes.LAST_DAY) -> DataFrame:
    """The order backlog dataset.

    Orders of the span and their lines are stage tables; everything that is summed for them is read by their keys.
    What an order's own columns decide is looked up per order, what a line's decide per line; the two are staged and meet last.
    """
    shown = staged(orders_of(t, (first_day, last_day)), "backlog_orders")
    keys = staged_keys(shown, list(_ORDER), "backlog_order_keys")
    items = staged(rows_of(t["ipedido"], keys, _BY_ORDER), "backlog_items")
    # One after the other: only the shuffles of one stage are on disk.
    prices = last_purchase_price(t, staged_keys(items, ["codi_psv"], "backlog_products"))
    lines = staged(order_lines(t, keys, items), "backlog_lines")
    priced = lookup(products(t), prices, {"codi_psv": "codi_psv"}, {"ult_compra": "price"})
    lines = lookup(lines, priced, {"codi_psv": "codi_psv"},
                   {"desc_psv": "desc_psv", "codi_gpr": "codi_gpr", "desc_gpr": "desc_gpr", "codi_sbg": "known_sbg",
                    "desc_sbg": "desc_sbg", "cod_fabricante": "cod_fabricante", "fabricante": "fabricante",
                    "principio_ativo": joined_text("active_code", F.lit("-"), "active"), "unidade": "unid_psv",
                    "ult_compra": "ult_compra"}, "inner")
    lines = staged(lines, "backlog_priced")
    orders = staged(order_heads(t, shown, keys), "backlog_heads")
    lines = lookup(lines, orders, _ORDER, {c: c for c in orders.columns if c not in _ORDER}, "inner")

    def other(value: Column | str) -> Column:
        return to_other_currency(value, "vlor_vlr")

    own_flow = ~F.col("controlled")
    arrived = F.when(own_flow, F.col("sent")).otherwise(F.coalesce("qent", F.lit(0)))
    balance = open_balance(own_flow, "qtde_ipe", "qper_ipe", "qdev", "sent", "qent")
    total = F.col("qtde_ipe") * F.col("vliq_ipe")
    shaped = {
        "tota_om_ped": other("tota_ped"), "qtde_pedida": F.col("qtde_ipe"), "qtde_entregue": arrived,
        "qtde_perdida": F.col("qper_ipe"), "saldo": balance, "qtde_pedida_om": other("qtde_ipe"),
        "qtde_entregue_om": other(arrived), "qtde_perdida_om": other("qper_ipe"), "saldo_om": other(balance),
        "vlr_unit": F.col("vliq_ipe"), "vlr_unit_om": other("vliq_ipe"), "total_item": total, "total_item_om": other(total),
        "cust_tab": F.col("ctab_ipe"), "cust_tab_om": other("ctab_ipe"), "custo_compra": F.col("ccpd_ipe"),
        "moeda_rt": code_label("moeda", codes.CURRENCIES), "pedido_origem": F.col("pedo_ped"),
        "contrato_barter": F.col("nume_ccp"), "venda_perdida_real": F.coalesce("lost", F.lit(0)),
    }
    return lines.select(*[shaped.get(name, F.col(name)).alias(name) for name in COLUMNS])
