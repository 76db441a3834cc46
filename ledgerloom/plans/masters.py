"""The seven master-data datasets: partners, products, stores, farms, people.

They are stored as tables, so the row order of the source reports is left to whoever reads
them; total_order() gives it at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import joined_text, tax_id_mask
from ledgerloom.operators.joins import lookup
from ledgerloom.plans import codes
from ledgerloom.sources.erp import Tables


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for name, source in names.items()])


def _with_city(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t["municipio"], {"codi_mun": "codi_mun"}, {"city": "desc_mun", "state": "esta_mun"})


def customers(t: Tables) -> DataFrame:
    partners = _with_city(t["transac"].where("clie_tra = 'S'"), t)
    known = lookup(partners, t["cliente"], {"codi_tra": "codi_tra"},
                   {"store": "codi_emp", "rg": "rgco_cli", "issuer": "oeco_cli", "seller": "cod1_pes"})
    named = known.withColumn("tax_id", tax_id_mask("tjur_tra", "cgc_tra"))
    named = named.withColumn("rg", joined_text("rg", F.lit(" - "), "issuer"))
    return _renamed(named, {
        "codi_loja": "store", "codi_cliente": "codi_tra", "nome_cliente": "raza_tra", "cpf_cnpj": "tax_id",
        "fone": "tel1_tra", "rg": "rg", "end_cobranca": "cend_tra", "cidade_cobranca": "city", "uf_cobranca": "state",
        "situ_cliente": "situ_tra", "codi_ctv_vendedor": "seller",
    })


def suppliers(t: Tables) -> DataFrame:
    partners = _with_city(t["transac"].where("forn_tra = 'S'"), t)
    return _renamed(partners.withColumn("tax_id", tax_id_mask("tjur_tra", "cgc_tra")), {
        "codi_forn": "codi_tra", "nome_forn": "raza_tra", "cpf_cnpj": "tax_id", "fone": "tel1_tra",
        "end_cobranca": "cend_tra", "cidade_cobranca": "city", "uf_cobranca": "state", "situ_forn": "situ_tra",
    })


def product_groups(t: Tables) -> DataFrame:
    groups = t["grupo"].where(F.col("codi_gpr").isin(codes.GROUPS))
    split = lookup(groups, t["subgrupo"], {"codi_gpr": "codi_gpr"}, {"sub": "codi_sbg", "sub_text": "desc_sbg"})
    return _renamed(split, {
        "codi_grupo": "codi_gpr", "grupo": "desc_gpr", "situ_grupo": "situ_gpr", "codi_subgrupo": "sub", "subgrupo": "sub_text",
    })


def stores(t: Tables) -> DataFrame:
    return _renamed(_with_city(t["cademp"].where("situ_emp = 'A'"), t), {
        "codi_loja": "codi_emp", "nome_loja": "iden_emp", "codi_mun": "codi_mun", "municipio": "city",
        "cnpj_emp": "cnpj_emp", "insc_estadual": "ine_emp",
    })


def products(t: Tables) -> DataFrame:
    listed = t["prodserv"].where(F.col("codi_gpr").isin(codes.PRODUCT_GROUPS))
    made = lookup(listed, t["produto"], {"codi_psv": "codi_psv"}, {"maker": "codi_tra"})
    made = lookup(made, t["transac"], {"maker": "codi_tra"}, {"maker_name": "raza_tra"})
    grouped = lookup(made, t["grupo"], {"codi_gpr": "codi_gpr"}, {"group": "codi_gpr", "group_text": "desc_gpr"})
    split = lookup(grouped, t["subgrupo"], {"codi_gpr": "codi_gpr", "codi_sbg": "codi_sbg"},
                   {"sub": "codi_sbg", "sub_text": "desc_sbg"})
    return _renamed(split, {
        "codi_produto": "codi_psv", "produto": "desc_psv", "unid": "unid_psv", "codi_grupo": "group", "grupo": "group_text",
        "codi_subgrupo": "sub", "subgrupo": "sub_text", "codi_fornecedor": "maker", "fornecedor": "maker_name",
        "situ_produto": "situ_psv",
    })


def properties(t: Tables) -> DataFrame:
    sold = lookup(t["propried"], t["vendedorpropried"], {"prop_pro": "prop_pro"}, {"seller": "cod1_pes"})
    owned = lookup(sold, t["transac"], {"codi_tra": "codi_tra"}, {"owner": "raza_tra", "owner_state": "situ_tra"})
    return _renamed(_with_city(owned, t), {
        "codi_parceiro": "codi_tra", "parceiro": "owner", "situ_parceiro": "owner_state", "codi_propriedade": "prop_pro",
        "propriedade": "desc_pro", "endereco": "ende_pro", "bairro": "bair_pro", "inscr_estadual": "isne_pro",
        "area_propried": "area_pro", "municipio": "city", "situ_propried": "situ_pro", "codi_ctv_vendedor": "seller",
    })


def users(t: Tables) -> DataFrame:
    placed = lookup(t["pessoal"], t["cargo"], {"codi_car": "codi_car"}, {"role": "desc_car"})
    return _renamed(placed, {
        "codi_pessoal": "codi_pes", "codi_empresa": "codi_emp", "nome_usuario": "nome_pes", "endereco": "ende_pes",
        "telefone": "tele_pes", "email": "emai_pes", "cpf": "cpf_pes", "dt_nascimento": "dnas_pes", "codi_cargo": "codi_car",
        "desc_cargo": "role",
    })
