"""Order backlog and the master-data reports over the derived ERP tables."""

from ledgerloom.plans import codes, masters
from ledgerloom.plans.backlog import backlog
from ledgerloom.queries.base import portable_sql, query
from ledgerloom.queries.standin import ErpTables, erp_ctes

SPAN = ("1995-07-01", "2030-12-31")

_BACKLOG_TABLES = """pedido ipedido prefinan ocorrencias qtde_entr_ped_ven nota inota nfentra infentra negociacao indvalor
indexador topctrl funcaotoper cfo tipooper transac municipio cademp propried ciclo condicao pessoal cadusu prodserv grupo
subgrupo produto prinativos cabtab""".split()


def _other(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / CAST(coalesce(v.vlor_vlr, 1) AS DOUBLE)"


_FLOW = "CASE WHEN o.own_flow THEN {} ELSE {} END"
_ARRIVED = _FLOW.format("o.sent", "coalesce(d.qent, 0)")
_LEFT = _FLOW.format("o.ordered - o.skipped - o.sent", "o.ordered - o.skipped - coalesce(d.qdev, 0) - coalesce(d.qent, 0)")

BACKLOG_SQL = portable_sql(f"""
WITH {erp_ctes(*_BACKLOG_TABLES)},
o AS (
  SELECT p.*, i.codi_psv, i.qtde_ipe AS ordered, coalesce(i.qper_ipe, 0) AS skipped, i.vliq_ipe, i.ctab_ipe, i.tabe_cta, i.ccpd_ipe,
    p.codi_top NOT IN (SELECT codi_top FROM topctrl WHERE codi_ctr = {codes.DELIVERY_CONTROL}) AS own_flow,
    (SELECT sum(f.qent) FROM qtde_entr_ped_ven f WHERE f.codi_emp = p.codi_emp AND f.pedi_ped = p.pedi_ped
        AND f.seri_ped = p.seri_ped AND f.codi_psv = i.codi_psv) AS sent,
    coalesce((SELECT sum(x.qtde_oco) FROM ocorrencias x WHERE x.pedi_ped = p.pedi_ped AND x.seri_ped = p.seri_ped
        AND x.codi_emp = p.codi_emp AND x.codi_psv = i.codi_psv AND x.codi_prv NOT IN (7, 12)), 0) AS lost
  FROM pedido p JOIN ipedido i USING (codi_emp, pedi_ped, seri_ped)
  WHERE p.situ_ped <> '9' AND p.demi_ped BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}'),
terms AS (
  SELECT p.codi_emp, p.pedi_ped, p.seri_ped, string_agg(strftime(p.vcto_ped + f.praz_pfp, '%d/%m/%Y'), ';' ORDER BY f.praz_pfp) AS days
  FROM prefinan f JOIN pedido p USING (codi_emp, pedi_ped, seri_ped) GROUP BY ALL),
d AS (
  SELECT pedi_ped, seri_ped, codi_psv, empr_ped, sum(coalesce(qdev_ino, 0)) AS qdev, sum(coalesce(qent_ino, 0)) AS qent
  FROM inota JOIN nota USING (npre_not) WHERE situ_not <> '9' AND pedi_ped IS NOT NULL GROUP BY ALL),
n AS (
  SELECT g.*, r.vlor_vlr AS rate, CASE WHEN tipo_neg = 3 AND moed_ind = 'D' THEN r.vlor_vlr END AS barter_rate,
    CASE tipo_neg WHEN 1 THEN 'REAL' WHEN 2 THEN 'DOLAR' WHEN 3 THEN CASE moed_ind WHEN 'R' THEN 'TROCA-REAL' WHEN 'D' THEN 'TROCA-DOLAR' END END AS kind
  FROM negociacao g LEFT JOIN indvalor r ON r.codi_ind = g.codi_ind AND r.codi_emp = g.codi_emp AND r.data_vlr = g.data_vlr),
bought AS (
  SELECT codi_psv, price FROM (
    SELECT l.codi_psv, l.vliq_inf AS price, row_number() OVER (PARTITION BY l.codi_psv
        ORDER BY h.drec_nfe DESC NULLS FIRST, h.nume_nfe DESC NULLS FIRST, l.vliq_inf DESC NULLS FIRST) AS place
    FROM infentra l JOIN nfentra h ON h.ctrl_nfe = l.ctrl_nfe AND h.codi_tra = l.codi_tra AND h.seri_nfe = l.seri_nfe
      AND h.nume_nfe = l.nume_nfe AND h.codi_emp = l.codi_emp
    JOIN cfo c ON c.ccfo_cfo = h.ccfo_cfo AND c.comp_cfo <> '2' JOIN funcaotoper f ON f.codi_top = h.codi_top AND f.codi_pto = 1) AS k
  WHERE place = 1)
SELECT o.codi_emp, em.desc_mun, o.pedi_ped, o.seri_ped, o.demi_ped, t.codi_tra, t.cgc_tra, t.raza_tra, q.prop_pro, q.desc_pro,
  cy.codi_cic, cy.desc_cic, k.cond_con, k.desc_con, w.codi_pes, w.nome_pes, y.codi_top, y.desc_top, c.ccfo_cfo, c.desc_cfo,
  o.vcto_ped, z.days AS venc_pfp, v.codi_ind, v.desc_ind, v.vlor_vlr, o.tota_ped, {_other('o.tota_ped')} AS tota_om_ped,
  a.codi_psv, a.desc_psv, a.codi_gpr, b.desc_gpr, s.codi_sbg, s.desc_sbg, fab.codi_tra AS cod_fabricante, fab.raza_tra AS fabricante,
  o.ordered AS qtde_pedida, {_ARRIVED} AS qtde_entregue, o.skipped AS qtde_perdida, {_LEFT} AS saldo,
  {_other('o.ordered')} AS qtde_pedida_om, {_other(_ARRIVED)} AS qtde_entregue_om, {_other('o.skipped')} AS qtde_perdida_om,
  {_other(_LEFT)} AS saldo_om, o.vliq_ipe AS vlr_unit, {_other('o.vliq_ipe')} AS vlr_unit_om, o.ordered * o.vliq_ipe AS total_item,
  {_other('o.ordered * o.vliq_ipe')} AS total_item_om, o.ctab_ipe AS cust_tab, {_other('o.ctab_ipe')} AS cust_tab_om,
  pl.tabe_cta, pl.desc_cta, u.nome_pes AS usu_inclusao, o.ccpd_ipe AS custo_compra,
  coalesce(CAST(ac.codi_pri AS VARCHAR), '') || '-' || coalesce(ac.desc_pri, '') AS principio_ativo, a.unid_psv AS unidade,
  CASE n.moed_ind WHEN 'R' THEN 'REAL' WHEN 'D' THEN 'DOLAR' END AS moeda_rt, n.vlul_neg AS rt, n.rate AS cotacao_dolar,
  bo.price AS ult_compra, o.pedo_ped AS pedido_origem, n.nume_neg AS numero_negociacao, n.kind AS tipo_negociacao,
  n.vluc_neg AS rt_liquida, n.barter_rate AS cotacao_dolar_negociacao, o.nume_ccp AS contrato_barter, o.lost AS venda_perdida_real
FROM o
JOIN (SELECT e.codi_emp, m.desc_mun FROM cademp e JOIN municipio m USING (codi_mun)) em ON em.codi_emp = o.codi_emp
JOIN transac t ON t.codi_tra = o.codi_tra
JOIN prodserv a ON a.codi_psv = o.codi_psv JOIN grupo b ON b.codi_gpr = a.codi_gpr JOIN produto pr ON pr.codi_psv = a.codi_psv
LEFT JOIN subgrupo s ON s.codi_sbg = a.codi_sbg AND s.codi_gpr = a.codi_gpr LEFT JOIN prinativos ac ON ac.codi_pri = a.codi_pri
LEFT JOIN transac fab ON fab.codi_tra = pr.codi_tra LEFT JOIN bought bo ON bo.codi_psv = a.codi_psv
LEFT JOIN terms z ON z.codi_emp = o.codi_emp AND z.pedi_ped = o.pedi_ped AND z.seri_ped = o.seri_ped
LEFT JOIN d ON d.pedi_ped = o.pedi_ped AND d.seri_ped = o.seri_ped AND d.empr_ped = o.codi_emp AND d.codi_psv = o.codi_psv
LEFT JOIN n ON n.ctrl_neg = o.ctrl_neg AND n.codi_pes = o.cod1_pes AND n.codi_emp = o.codi_emp
LEFT JOIN (SELECT r.*, x.desc_ind FROM indvalor r JOIN indexador x USING (codi_ind)) v
  ON v.codi_emp = o.codi_emp AND v.codi_ind = o.codi_ind AND v.data_vlr = o.data_vlr
LEFT JOIN propried q ON q.prop_pro = o.prop_pro LEFT JOIN ciclo cy ON cy.codi_cic = o.codi_cic
LEFT JOIN condicao k ON k.cond_con = o.cond_con LEFT JOIN cfo c ON c.ccfo_cfo = o.ccfo_cfo
LEFT JOIN pessoal w ON w.codi_pes = o.cod1_pes LEFT JOIN tipooper y ON y.codi_top = o.codi_top
LEFT JOIN cabtab pl ON pl.tabe_cta = o.tabe_cta
LEFT JOIN (SELECT cu.codi_usu, pe.nome_pes FROM cadusu cu JOIN pessoal pe USING (codi_pes)) u ON u.codi_usu = o.codi_usu
""", """vlor_vlr tota_ped qtde_pedida qtde_entregue qtde_perdida saldo vlr_unit total_item cust_tab custo_compra rt
cotacao_dolar ult_compra rt_liquida cotacao_dolar_negociacao venda_perdida_real""", "demi_ped vcto_ped")


@query(BACKLOG_SQL)
def mart_order_backlog(spark, sf_dir):
    return backlog(ErpTables(spark, sf_dir), *SPAN)


_TAX_ID = r"""CASE tjur_tra
  WHEN 'J' THEN regexp_replace(lpad(cgc_tra, 14, '0'), '^(\d\d)(\d{3})(\d{3})(\d{4})(\d\d)$', '\1.\2.\3/\4-\5')
  WHEN 'F' THEN regexp_replace(lpad(cgc_tra, 11, '0'), '^(\d{3})(\d{3})(\d{3})(\d\d)$', '\1.\2.\3-\4') END"""


@query(f"""
WITH {erp_ctes('transac', 'cliente', 'municipio')}
SELECT c.codi_emp AS codi_loja, t.codi_tra AS codi_cliente, t.raza_tra AS nome_cliente, {_TAX_ID} AS cpf_cnpj, t.tel1_tra AS fone,
  coalesce(c.rgco_cli, '') || ' - ' || coalesce(c.oeco_cli, '') AS rg, t.cend_tra AS end_cobranca, m.desc_mun AS cidade_cobranca,
  m.esta_mun AS uf_cobranca, t.situ_tra AS situ_cliente, c.cod1_pes AS codi_ctv_vendedor
FROM transac t LEFT JOIN cliente c USING (codi_tra) LEFT JOIN municipio m USING (codi_mun) WHERE t.clie_tra = 'S'""")
def mart_customers(spark, sf_dir):
    return masters.customers(ErpTables(spark, sf_dir))


@query(f"""
WITH {erp_ctes('transac', 'municipio')}
SELECT codi_tra AS codi_forn, raza_tra AS nome_forn, {_TAX_ID} AS cpf_cnpj, tel1_tra AS fone, cend_tra AS end_cobranca,
  desc_mun AS cidade_cobranca, esta_mun AS uf_cobranca, situ_tra AS situ_forn
FROM transac LEFT JOIN municipio USING (codi_mun) WHERE forn_tra = 'S'""")
def mart_suppliers(spark, sf_dir):
    return masters.suppliers(ErpTables(spark, sf_dir))


@query(f"""
WITH {erp_ctes('grupo', 'subgrupo')}
SELECT g.codi_gpr AS codi_grupo, desc_gpr AS grupo, situ_gpr AS situ_grupo, codi_sbg AS codi_subgrupo, desc_sbg AS subgrupo
FROM grupo g LEFT JOIN subgrupo s USING (codi_gpr) WHERE g.codi_gpr <= 5""")
def mart_product_groups(spark, sf_dir):
    return masters.product_groups(ErpTables(spark, sf_dir))


@query(f"""
WITH {erp_ctes('cademp', 'municipio')}
SELECT codi_emp AS codi_loja, iden_emp AS nome_loja, e.codi_mun, desc_mun AS municipio, cnpj_emp, ine_emp AS insc_estadual
FROM cademp e LEFT JOIN municipio m ON m.codi_mun = e.codi_mun WHERE situ_emp = 'A'""")
def mart_stores(spark, sf_dir):
    return masters.stores(ErpTables(spark, sf_dir))


@query(f"""
WITH {erp_ctes('prodserv', 'produto', 'transac', 'grupo', 'subgrupo')}
SELECT a.codi_psv AS codi_produto, desc_psv AS produto, unid_psv AS unid, g.codi_gpr AS codi_grupo, desc_gpr AS grupo,
  s.codi_sbg AS codi_subgrupo, desc_sbg AS subgrupo, p.codi_tra AS codi_fornecedor, raza_tra AS fornecedor, situ_psv AS situ_produto
FROM prodserv a LEFT JOIN produto p ON p.codi_psv = a.codi_psv LEFT JOIN transac t ON t.codi_tra = p.codi_tra
LEFT JOIN grupo g ON g.codi_gpr = a.codi_gpr LEFT JOIN subgrupo s ON s.codi_gpr = a.codi_gpr AND s.codi_sbg = a.codi_sbg
WHERE a.codi_gpr IN (1, 2, 3, 4, 5, 6, 462)""")
def mart_products(spark, sf_dir):
    return masters.products(ErpTables(spark, sf_dir))


@query(portable_sql(f"""
WITH {erp_ctes('propried', 'vendedorpropried', 'transac', 'municipio')}
SELECT p.codi_tra AS codi_parceiro, raza_tra AS parceiro, situ_tra AS situ_parceiro, p.prop_pro AS codi_propriedade, desc_pro AS propriedade,
  ende_pro AS endereco, bair_pro AS bairro, isne_pro AS inscr_estadual, area_pro AS area_propried, desc_mun AS municipio,
  situ_pro AS situ_propried, cod1_pes AS codi_ctv_vendedor
FROM propried p LEFT JOIN vendedorpropried v ON v.prop_pro = p.prop_pro LEFT JOIN transac t ON t.codi_tra = p.codi_tra
LEFT JOIN municipio m ON m.codi_mun = p.codi_mun""", "area_propried"))
def mart_properties(spark, sf_dir):
    return masters.properties(ErpTables(spark, sf_dir))


@query(portable_sql(f"""
WITH {erp_ctes('pessoal', 'cargo')}
SELECT codi_pes AS codi_pessoal, codi_emp AS codi_empresa, nome_pes AS nome_usuario, ende_pes AS endereco, tele_pes AS telefone,
  emai_pes AS email, cpf_pes AS cpf, dnas_pes AS dt_nascimento, p.codi_car AS codi_cargo, desc_car AS desc_cargo
FROM pessoal p LEFT JOIN cargo c ON c.codi_car = p.codi_car""", "", "dt_nascimento"))
def mart_users(spark, sf_dir):
    return masters.users(ErpTables(spark, sf_dir))
