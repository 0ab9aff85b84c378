"""Legacy-shaped tables derived from the test tables.

Each entry is one SQL text run unchanged by Spark (to build the input DataFrames) and by DuckDB
(as a CTE in the oracle queries), so both engines start from the same rows. They stand in for the
legacy databases (ALMOX, COMPRAS, FROTAS, PATRI, PPA) and for rows already present in the target.
Filters such as ``% 7 <> 0`` shape the data (suppliers without an address, bids without an item
object, ...); they decide which legacy rows exist, not how much of them a query reads.
"""

from __future__ import annotations

ADAPTERS: dict[str, str] = {
    "unidademedida": (
        "select cast(n_nationkey as int) cdunidademedida, concat('U', cast(n_nationkey as string)) sgunidademedida, "
        "n_name dsunidademedida from nation"
    ),
    "classificacao": (
        "select distinct cast(substring(p_brand,7) as int) cdclassereduzido, concat('CLASSE ', p_brand) "
        "dsclassificacao, cast(substring(p_brand,7) as int) % 3 + 1 nrnivel from part"
    ),
    "patri_classificacao": (
        "select distinct cast(substring(p_brand,7) as int) cdclassereduzido, concat('CLASSE ', p_brand) "
        "dsclassificacao, cast(substring(p_brand,7) as int) % 3 + 1 nrnivel from part"
    ),
    "classificacao_bens": (
        "select distinct cast(substring(p_brand,7) as int) cdclassereduzido, concat('BENS ', p_brand) dsclassificacao "
        "from part"
    ),
    "classificacao_obras": (
        "select distinct cast(substring(p_brand,7) as int) cdclassereduzido, concat('OBRAS ', p_brand) dsclassificacao "
        "from part where cast(substring(p_brand,7) as int) % 5 <> 0"
    ),
    "produto": (
        "select p_partkey cdmaterial, p_size % 3 + 1 tpmaterial, cast(substring(p_brand,7) as int) + case when p_partkey % 97 = 5 "
        "and p_size % 3 < 2 then 100 else 0 end cdclassereduzido, "
        "upper(p_name) dsmaterial, p_size % 30 cdunidademedida, p_type descricao_unica from part"
    ),
    "produto_wide": (
        "select o_orderkey cdmaterial, 1 tpmaterial, cast(substring(o_orderpriority,1,1) as int) cdclassereduzido, "
        "o_orderpriority dsmaterial, 1 cdunidademedida from orders"
    ),
    "classificacao_wide": (
        "select distinct cast(substring(o_orderpriority,1,1) as int) cdclassereduzido, concat('PRIORIDADE ', "
        "o_orderpriority) dsclassificacao from orders"
    ),
    "almoxarifado": (
        "select r_regionkey + 1 cdalmoxarifado, r_name dsalmoxarifado from region"
    ),
    "fornecedor": (
        "select s_suppkey + 1 cdfornecedor, upper(s_name) nmfornecedor, s_name nmfantasia, cast(case s_suppkey % 4 when "
        "0 then 10000000000 when 1 then 1000000000 when 2 then 10000000000000 else 100000000000 end + s_suppkey * 97 as "
        "decimal(14,0)) nrcgccpf, case when s_suppkey % 2 = 0 then 'J' else 'F' end inpessoafisicajuridica, "
        "case when s_suppkey % 3 = 0 then concat('IE', cast(s_suppkey as string)) end nrinscricaoestadual, "
        "case when s_suppkey % 5 <> 0 then concat('IM', cast(s_suppkey as string)) end nrinscricaomunicipal from supplier"
    ),
    "enderecofornecedor": (
        "select s_suppkey + 1 cdfornecedor, 1 cdpais, n_regionkey cduf, s_nationkey cdmunicipio, concat('RUA ', "
        "cast(s_suppkey as string)) dsendereco, cast(null as string) dscomplementologradouro, lpad(cast(s_suppkey % 100000 as string), 8, '1') cdcep, "
        "s_suppkey % 3 cdlogradouro from supplier join nation "
        "on s_nationkey = n_nationkey where s_suppkey % 7 <> 0 union all select s_suppkey + 1, 1, r_regionkey, 99, "
        "concat('AVENIDA ', cast(s_suppkey as string)), 'FUNDOS', cast(null as string), cast(null as bigint) from supplier cross join region where s_suppkey % 5 = "
        "0 and r_regionkey = 0"
    ),
    "logradouro": (
        "select 1 cdpais, n_regionkey cduf, n_nationkey cdmunicipio, r_regionkey cdlogradouro, concat('LOGRADOURO ', r_name, ' DE ', n_name) "
        "nmlogradouro from nation cross join region"
    ),
    "desorc": (
        "select lpad(cast(r_regionkey + 1 as string), 2, '0') poder, '01' orgao, lpad(cast(r_regionkey % 2 + 1 as string), 2, '0') unidade, "
        "r_regionkey % 2 + 1 empresa from region"
    ),
    "municipio": (
        "select 1 cdpais, n_regionkey cduf, n_nationkey cdmunicipio, n_name nmmunicipio from nation"
    ),
    "unidadefederacao": (
        "select 1 cdpais, r_regionkey cduf, substring(r_name,1,2) sguf from region"
    ),
    "contacorrentefornecedor": (
        "select s_suppkey + 1 cdfornecedor, s_suppkey % 9 cdbanco, s_suppkey % 13 cdagencia, s_suppkey cdcontacorrente "
        "from supplier where s_suppkey % 3 <> 0"
    ),
    "desfor_existing": (
        "select s_suppkey + 1000 codif, case when s_suppkey % 3 = 0 then cast(cast(case s_suppkey % 4 when 0 then "
        "10000000000 when 1 then 1000000000 when 2 then 10000000000000 else 100000000000 end + s_suppkey * 97 as "
        "decimal(14,0)) as string) end audesp_numero, case when s_suppkey % 3 = 1 then upper(s_name) else 'OUTRO' end "
        "nome, case when s_suppkey % 15 <> 4 then concat('DOC ', cast(s_suppkey as string)) end insmf, "
        "case when s_suppkey % 2 = 0 then 'CONTABIL' end modulo, cast(s_suppkey + 5 as string) codant from supplier where s_suppkey % 3 < 2 "
        # what an earlier load of the purchasing module has left
        "union all select s_suppkey + 50000000, null, upper(s_name), 'DOC', 'COMPRAS', cast(s_suppkey + 1 as string) from supplier"
    ),
    "requi_existing": (
        "select 1 empresa, s_suppkey + 1 id_requi, case s_suppkey % 4 when 0 then '00000/97' when 1 then concat(lpad(cast(s_suppkey % 90000 as string), 5, '0'), "
        "'/98') end requi, lpad(cast(s_suppkey % 90000 as string), 5, '0') num, 1997 ano, cast(s_nationkey as bigint) docum from supplier"
    ),
    "icadreq_existing": (
        "select 1 empresa, s_suppkey + 1 id_requi, case s_suppkey % 4 when 0 then '00000/97' when 1 then concat(lpad(cast(s_suppkey % 90000 as string), 5, '0'), "
        "'/98') end requi, cast(part.n as bigint) item, concat('001.000.', lpad(cast(s_nationkey as string), 3, '0')) cadpro, "
        "cast(s_nationkey + part.n as double) quan1, case when s_suppkey % 8 = 3 and part.n = 1 then concat('AAA', cast(s_suppkey as string)) end placa "
        "from supplier join (select 1 n union all select 2) part on part.n <= s_suppkey % 2 + 1"
    ),
    "orgao": (
        "select n_nationkey cdorgaoreduzido, n_name naorgao, concat('ORGAO ', n_name) nmorgao, 1998 dtano from nation union all "
        "select n_nationkey, concat(n_name,' B'), concat('ORGAO ', n_name, ' B'), 1999 from nation where n_nationkey % 4 = 0"
    ),
    "processopesquisa": (
        "select o_orderkey nrpesquisa, cast(year(o_orderdate) as int) dtanopesquisa, case when o_orderkey % 6 = 0 then "
        "null else o_orderkey % 5000 end nrprocesso, case when o_orderkey % 6 = 0 then null else cast(year(o_orderdate) "
        "as int) end dtanoprocesso, lower(o_orderpriority) dspesquisa, o_orderdate dtexpedicao, case when o_orderkey % "
        "4 = 0 then null else upper(o_orderpriority) end justificativa_contratacao, cast(substring(o_orderpriority,1,1) "
        "as int) cdcondicaopagamento, case when o_custkey % 30 < 28 then o_custkey % 30 end cdlocalentrega from orders"
    ),
    "itempesquisa": (
        "select l_orderkey nrpesquisa, cast(year(o_orderdate) as int) dtanopesquisa, l_linenumber % 2 + 1 lote, "
        "l_linenumber nritem, min(l_partkey) cdmaterial, cast(sum(l_quantity) as decimal(18,5)) qtitempesquisa from "
        "lineitem join orders on o_orderkey = l_orderkey group by l_orderkey, cast(year(o_orderdate) as int), "
        "l_linenumber"
    ),
    "orgaopesquisa": (
        "select o_orderkey nrpesquisa, cast(year(o_orderdate) as int) dtanopesquisa, c_nationkey cdorgaoreduzido from "
        "orders join customer on c_custkey = o_custkey"
    ),
    "propostapesquisa": (
        "select l_orderkey nrpesquisa, cast(year(o_orderdate) as int) dtanopesquisa, l_linenumber % 2 + 1 lote, "
        "l_linenumber nritemproposta, l_suppkey + 1 cdfornecedor, min(case when l_discount = 0 then cast(0 as "
        "decimal(18,5)) else cast(floor(l_extendedprice / l_quantity * 100) / 100 as decimal(18,5)) end) "
        "vlcotacaoproposta, cast(sum(l_quantity) as decimal(18,5)) qtitemproposta from lineitem join orders on "
        "o_orderkey = l_orderkey group by l_orderkey, cast(year(o_orderdate) as int), l_linenumber, l_suppkey"
    ),
    "processolicitatorio": (
        "select o_orderkey pkid, o_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, "
        "case cast(substring(o_orderpriority,1,1) as int) when 1 then 1 when 2 then 2 when 3 then 5 when 4 then 8 else "
        "case when o_orderkey % 11 = 0 then 99 else 3 end end cdtipomodalidade, case when o_orderpriority like '4%' and "
        "o_orderstatus = 'F' then -1 else 0 end inpregaoeletronico, case when o_orderstatus = 'O' then -1 else 0 end "
        "inregistropreco, case when o_orderkey % 10 = 0 then 1 else 0 end cdunidadegestora, case when o_orderkey % 3 = "
        "0 then 'Menor preço - Global' else 'Menor preço - Item' end dscriterio, o_orderdate dtexpedicao, case when "
        "o_orderkey % 8 = 0 then null else o_orderdate end dthomologacao, "
        "repeat(concat(o_orderpriority, ' '), cast(o_orderkey % 100 as int)) daobjeto, concat('Objeto ', o_orderpriority) dsobjeto, "
        "o_orderkey % 300 nrmodalidade, cast(substring(o_orderpriority,1,1) as int) cdcondicaopagamento, "
        "case when o_orderkey % 9 = 0 then null else o_orderdate end dtrespostasolicitacao, "
        "case when o_orderkey % 5 = 0 then null else o_orderdate end dtinicioenvioproposta, "
        "case when o_orderkey % 7 = 0 then null else o_orderdate end dtterminorecebimento, "
        "case when o_orderkey % 13 = 0 then null else o_orderdate end dtjulgamentoproposta from orders"
    ),
    "cadlic_sessao_existing": (
        "select o_orderkey numlic from orders where o_orderkey % 17 = 0"
    ),
    "regprecodoc_existing": (
        "select o_orderkey numlic from orders where o_orderkey % 19 = 0"
    ),
    "itemobjeto": (
        "select l_orderkey id_processolicitatorio, l_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, "
        "4 cdtipoprocesso, l_linenumber % 3 lote, l_linenumber + case when l_linenumber = 7 then 100 else 0 end nritem, "
        "min(l_partkey) cdmaterial, concat('LOTE ', cast(l_linenumber % 3 as string), case when l_orderkey % 7 = 2 then "
        "concat(' ITEM ', cast(l_linenumber as string)) else '' end) nmlote, cast(sum(l_quantity) as decimal(18,5)) "
        "qtitemobjeto from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey, cast(year(o_orderdate) as "
        "int), l_linenumber"
    ),
    "itemdespesa": (
        "select l_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, l_linenumber % 3 lote, "
        "l_linenumber nritem, cast(year(o_orderdate) as int) dtanoexercicio, cast((l_orderkey + l_linenumber + part.n) % 40 as int) "
        "cddespesa, case when l_orderkey % 12 = 5 then null else cast(sum(l_quantity) * (part.n + 1) as decimal(18,5)) end qtdeitem, "
        "case when l_orderkey % 14 = 3 then null else cast(floor(min(l_extendedprice / l_quantity) * 100) / 100 as decimal(18,5)) end "
        "valor_estimado from lineitem join orders on o_orderkey = l_orderkey join (select 0 n union all select 1) part on "
        "part.n <= l_linenumber % 2 group by l_orderkey, cast(year(o_orderdate) as int), l_linenumber, part.n"
    ),
    "despesa": (
        "select distinct cast(year(o_orderdate) as int) dtano, cast(o_orderkey % 40 as int) cddespesa, cast(o_orderkey % 40 % 25 as int) "
        "cdorgaoreduzido from orders where o_orderkey % 40 % 13 <> 7"
    ),
    "icadorc_fic": (
        "select concat(cast(l_orderkey as string), substring(cast(year(o_orderdate) as string), 3, 2)) id_cadorc, l_linenumber item, "
        "part.codigo, cast(l_orderkey % 40 as int) ficha, concat('3.3.90.', cast(30 + part.codigo as string)) elemento, "
        "cast(part.codigo as string) desdobro, concat('33903', cast(part.codigo as string)) balco_tce, case when l_orderkey % 10 = 9 then null "
        "else cast(sum(l_quantity) * part.codigo as decimal(18,5)) end qtd, case when l_orderkey % 9 = 4 then null else "
        "cast(sum(cast(floor(l_extendedprice * 100) / 100 as decimal(18,5))) as decimal(18,5)) end valor from lineitem join orders on o_orderkey = l_orderkey join "
        "(select 1 codigo union all select 2 union all select 3) part on part.codigo <= l_orderkey % 4 "
        "group by l_orderkey, cast(year(o_orderdate) as int), cast(year(o_orderdate) as string), l_linenumber, part.codigo"
    ),
    "classificacaoproposta": (
        "select fk_processo_licitatorio, nrprocesso, dtanoprocesso, cdtipoprocesso, lote, nritem, cdmaterial, "
        "cdfornecedor, vlcotacaoproposta, cast(row_number() over (partition by nrprocesso, nritem order by "
        "vlcotacaoproposta, cdfornecedor) as int) nrclassificacao, tpregistro, ordem, case when cdmaterial % 50 = 0 "
        "then cdmaterial else null end fk_tabela_preco_processo from (select l_orderkey fk_processo_licitatorio, "
        "l_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, l_linenumber % 3 lote, "
        "l_linenumber nritem, min(l_partkey) over (partition by l_orderkey, l_linenumber) cdmaterial, l_suppkey + 1 "
        "cdfornecedor, cast(floor(l_extendedprice / l_quantity * 100) / 100 as decimal(18,5)) vlcotacaoproposta, case "
        "when l_returnflag = 'R' then 'R' else 'C' end tpregistro, cast(l_partkey as int) ordem from lineitem join "
        "orders on o_orderkey = l_orderkey) q"
    ),
    "tabela_preco_item": (
        "select p_partkey pkid, p_partkey % 100 cd_produto from part where p_partkey % 50 = 0"
    ),
    "dataview_pedidoempenho": (
        "select o_orderkey nrempenho, cast(year(o_orderdate) as int) dtanoempenho, o_orderkey nrprocesso, "
        "cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, l_suppkey + 1 cdfornecedor, l_linenumber % 3 "
        "lote, l_linenumber nritem, case when o_orderstatus = 'O' then '1' else '0' end ehregistropreco, "
        "cast(l_quantity as decimal(18,5)) qtdeitem, cast(floor(l_extendedprice / l_quantity * 100) / 100 as "
        "decimal(18,5)) vlcotacaoproposta, cast(l_extendedprice as decimal(18,5)) vltotalitem, c_nationkey "
        "cdorgaoreduzido, o_orderdate dtempenho, o_orderkey + 7 nrempenhocp, cast(year(o_orderdate) as int) "
        "dtanoempenhocp, case when o_orderkey % 4 = 0 then o_orderkey else null end nrinstrumentocontratual, "
        "cast(year(o_orderdate) as int) dtanoinstrumentocontratual, cast(o_orderkey % 40 as int) cddespesa "
        "from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey"
    ),
    "integrainstrumentopedido": (
        "select l_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, l_linenumber % 3 lote, "
        "l_linenumber nritem, case when l_orderkey % 10 = 1 then l_partkey end cdmaterial from lineitem join orders on o_orderkey = l_orderkey"
    ),
    "despes": (
        "select o_orderkey pkemp, o_orderkey + 7 id_nrempenho, cast(year(o_orderdate) as int) id_dtanoemissao, "
        "cast(case when o_orderkey % 9 = 0 then 0 else o_totalprice end as decimal(18,5)) vadem from orders"
    ),
    "instrumentocontratual": (
        "select o_orderkey nrinstrumentocontratual, cast(year(o_orderdate) as int) dtanoinstrumentocontratual, 1 "
        "tpinstrumentocontratual, o_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, "
        "o_orderdate dtinstrumentocontratual, case when o_custkey % 30 < 25 then o_custkey % 30 end cdlocalentrega from orders"
    ),
    "instrumento_contratual_empenho": (
        # every contract has its own commitment, a third of them also the first one of their year
        "select o_orderkey * 2 + part.n pkid, o_orderkey nr_instrumento_contratual, cast(year(o_orderdate) as int) dt_ano_instrumento_contratual, "
        "1 tp_instrumento_contratual, case when part.n = 1 then first_order.k when o_orderkey % 16 = 0 then o_orderkey + 900000000 "
        "else o_orderkey end nr_empenho, cast(year(o_orderdate) as int) dt_ano_empenho from orders join (select 0 n union all select 1) part "
        "on part.n = 0 or o_orderkey % 3 = 0 join (select cast(year(o_orderdate) as int) y, min(o_orderkey) k from orders "
        "group by cast(year(o_orderdate) as int)) first_order on first_order.y = cast(year(o_orderdate) as int)"
    ),
    "localentrega": (
        "select n_nationkey cdlocalentrega, concat('ENTREGA EM ', n_name) dslocalentrega, "
        "case when n_nationkey % 4 <> 1 then concat('PORTAO ', cast(n_nationkey as string)) end dscomplemento from nation"
    ),
    "almox_movimento": (
        "select row_number() over (order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
        "l_extendedprice, l_discount, l_tax) nrlancamento, l_partkey cdmaterial, l_shipdate dtmovimento, l_orderkey "
        "nrdocumento, case concat(l_returnflag,l_linestatus) when 'RO' then 7 when 'AO' then 8 when 'NO' then 1 when "
        "'RF' then 2 when 'AF' then 9 else 12 end cdoperacao, cast(case when concat(l_returnflag,l_linestatus) in "
        "('RO','AO','NF') then l_quantity else 0 end as decimal(18,5)) qtdeentrada, cast(case when "
        "concat(l_returnflag,l_linestatus) in ('NO','RF','AF') then l_quantity / 2 else 0 end as decimal(18,5)) "
        "qtdesaida, case when l_partkey % 53 = 11 then null else cast(floor(l_extendedprice / l_quantity * 100) / 100 as decimal(18,5)) end vlcustoitem, "
        "cast(l_extendedprice as decimal(18,5)) sldvalor, case when l_suppkey % 10 = 0 then 0 else l_suppkey + 1 end "
        "cdfornecedor, cast(l_suppkey % 25 as int) cdorgaoreduzido, case when l_tax > 0 then l_orderkey end nrnota, "
        "case when l_tax > 0 then cast(l_linenumber as string) end nrserie from lineitem"
    ),
    "frotas_veiculo": (
        "select c_custkey cdveiculo, case when c_custkey % 25 = 0 then '' else concat('AB', chr(65 + cast(c_custkey % "
        "26 as int)), '-', lpad(cast(c_custkey as string), 4, '0')) end nrplacaveiculo, 1990 + cast(c_custkey % 20 as "
        "int) dtanofabricacao, c_custkey % 2000 cdcombustivel, "
        "c_nationkey % 6 cdtpveiculo, 1990 + cast(c_custkey % 20 as int) + cast(c_custkey % 2 as int) dtanomodelo, "
        "lpad(cast(c_custkey as string), 11, '0') nrrenavan, concat('9BW', lpad(cast(c_custkey as string), 14, '0')) nrchassi, "
        "c_custkey % 1000 * 10 nrmarcadorinicial, c_custkey % 1000 * 10 + c_nationkey * 100 nrmarcadoratual from customer"
    ),
    "centrocusto_placa": (
        "select c_custkey + 100 codccusto, concat('Carro placa ab', lower(chr(65 + cast(c_custkey % 26 as int))), ' ', "
        "lpad(cast(c_custkey as string), 4, '0')) descr from customer where c_custkey % 2 = 0"
    ),
    "movtoveiculo": (
        "select event_id nrsequencia, user_id cdveiculo, cast(ts as date) dtmovimento, event_id % 200 cditemmaterial, "
        "cast(value as decimal(18,5)) vlvalor, cast(event_id % 60 as decimal(18,5)) qtmovimentada, user_id % 100 + 1 "
        "cdfornecedormotorista, event_id % 1000 nrnfdepartamento, event_id % 200000 nrmarcador from events"
    ),
    "patri_item": (
        "select p_partkey cditem, case when p_partkey % 6 = 0 then '' else cast(p_partkey as string) end nrplaca, "
        "cast(p_partkey % 15 as int) cdtpingresso, p_size % 25 cdlocalizacao, cast(substring(p_brand,7) as int) "
        "cdclassificacao, p_size % 4 + 1 cdestadoconser, p_name dsreduzida, cast(p_retailprice as decimal(18,5)) "
        "vlaquisicao, p_size % 2 cdmetododepreciacao, p_size % 11 vidautil, cast(p_partkey % 3 as int) cdcontabil, "
        "concat('NF-', lpad(cast(p_partkey as string), 9, '0')) nrnotafiscal, "
        "case when p_partkey % 40 = 9 then null else date '2000-01-01' + cast(p_partkey % 6000 as int) end dtaquisicao, "
        "case when p_partkey % 4 = 0 then null else date '2000-02-01' + cast(p_partkey % 6000 as int) end dtiniciodepreciacao, "
        "cast(floor(p_retailprice * 90) / 100 as decimal(18,5)) vlatual, "
        "cast(floor(p_retailprice * 10) / 100 as decimal(18,5)) vlresidual, cast(p_partkey % 100 + 1 as int) cdfornecedor from part"
    ),
    "localizacao": (
        "select n_nationkey cdlocalreduzido, n_regionkey nrnivel, n_name dslocalizacao, case when n_nationkey % 6 = 5 "
        "then 1 else 0 end ininativa from nation"
    ),
    "patri_movimento": (
        "select l_partkey cditem, l_shipdate dtmovimento, case when l_linenumber = 1 then 'I' when l_returnflag = 'R' "
        "and l_linestatus = 'F' and l_linenumber = 7 then 'B' when l_returnflag = 'A' then 'T' when l_returnflag = 'N' "
        "then case when l_partkey % 10 = 3 then 'T' else 'R' end else 'E' end intipomovimento, cast(l_extendedprice as decimal(18,5)) vlareavaliar, "
        "cast(floor(l_extendedprice * 90) / 100 as decimal(18,5)) vlanterior, case when l_linenumber % 3 = 0 then null "
        "else cast(l_suppkey % 25 as int) end cdlocalanterior, case when l_returnflag = 'N' then null else "
        "cast(l_orderkey % 25 as int) end cdlocalatual, case when l_tax = 0 then -1 else 0 end inestorno, case when "
        "l_linenumber = 7 then 3 else null end cdtpbaixa, l_orderkey chmovimento, case when l_suppkey % 6 = 0 then null "
        "else l_suppkey % 7 end cdmotivo, kind.dsobservacao, kind.dsfundamento from lineitem join ("
        # a third of the orders has two movements that differ only in the end of a long text
        "select 0 part, cast(null as string) dsobservacao, cast(null as string) dsfundamento union all "
        "select 1, 'Conferido no inventario anual da comissao', concat(repeat('Lei de patrimonio publico, ', 40), 'artigo 1') union all "
        "select 1, 'Conferido no inventario anual da comissao', concat(repeat('Lei de patrimonio publico, ', 40), 'artigo 2') union all "
        "select 2, 'Termo de responsabilidade', 'Lei de patrimonio publico') kind on kind.part = l_orderkey % 3"
    ),
    "motivo": (
        "select r_regionkey cdmotivo, concat('MOTIVO ', r_name) dsmotivo from region"
    ),
    "movimentodepreciacao": (
        "select l_partkey cditem, l_shipdate dtmovimento, cast(floor(l_extendedprice) / 100 as decimal(18,5)) "
        "vldepreciacao, 0 inestorno, cast(null as timestamp) dtestorno from lineitem union all "
        "select l_partkey, l_shipdate, cast(floor(l_extendedprice) / 100 as decimal(18,5)), -1, l_shipdate from "
        "lineitem where l_orderkey % 11 = 0 or l_partkey % 10 = 7"
    ),
    "movimentovlcomplementar": (
        "select l_partkey + case when l_orderkey % 13 = 0 or l_partkey % 10 = 3 then 10000000 else 0 end cditem, l_shipdate dtmovimento, "
        "cast(l_tax * 100 as decimal(18,5)) vlcomplementar, 0 inestorno from lineitem"
    ),
    "iteminstrumentocontratual": (
        "select l_orderkey nrinstrumentocontratual, cast(year(o_orderdate) as int) dtanoinstrumentocontratual, 1 "
        "tpinstrumentocontratual, l_linenumber % 3 lote, l_linenumber nritem, min(l_partkey) cdmaterial, "
        "cast(sum(l_quantity) as decimal(18,5)) qtitem, cast(floor(min(l_extendedprice / l_quantity) * 100) / 100 as "
        "decimal(18,5)) valor_unitario, l_orderkey * 2 + case when l_orderkey % 3 = 0 and l_linenumber % 2 = 0 then 1 else 0 end "
        "fk_instrumento_contratual_empenho from lineitem join orders on o_orderkey = l_orderkey "
        "group by l_orderkey, cast(year(o_orderdate) as int), l_linenumber"
    ),
    "condicaopagamento": (
        "select distinct cast(substring(o_orderpriority,1,1) as int) cdcondicaopagamento, concat('PAGAMENTO EM ', "
        "o_orderpriority, ' DIAS APOS A ENTREGA') dscondicaopagamento from orders where substring(o_orderpriority,1,1) "
        "<> '5'"
    ),
    "motorista": (
        "select c_custkey cdfuncionario, c_name nmfuncionario, cast(10000000000 + c_custkey as decimal(14,0)) "
        "nrcarteirahabilitacao, c_mktsegment dslogradouro, concat('0055-11-9999-', c_name) nrfonemotorista, "
        "case when c_custkey % 8 = 0 then null else date '2024-01-01' + cast(c_custkey % 1500 as int) end dtvalidadehabilitacao, "
        "case c_custkey % 3 when 0 then 'B' when 1 then 'D' else 'AB' end cdcategoriahabilitacao from customer"
    ),
    "tipoveiculo": (
        "select r_regionkey cdtpveiculo, r_name dstpveiculo from region"
    ),
    "tipobaixa": (
        "select r_regionkey + 1 cdtpbaixa, concat('BAIXA ', r_name) dstpbaixa from region"
    ),
    "estadoconservacao": (
        "select r_regionkey + 1 cdestadoconser, concat('ESTADO ', r_name) dsestadoconser from region"
    ),
    "ppaplanoconta": (
        "select r_regionkey cdcontacontabil, case when r_regionkey = 0 then '1.2.3.2.1.01.02.00' else "
        "'1.2.3.1.1.05.03.00' end cdnivelcontabil from region where r_regionkey < 2"
    ),
    "conpla_tce": (
        "select distinct concat('CLASSE ', p_brand) titco, concat('1231', substring(p_brand,7)) balco from part where "
        "cast(substring(p_brand,7) as int) % 2 = 0"
    ),
    "tender_proposta": (
        "select distinct l_orderkey nrprocesso, cast(year(o_orderdate) as int) dtanoprocesso, 4 cdtipoprocesso, "
        "l_linenumber % 3 lote, l_suppkey + 1 cdfornecedor from lineitem join orders on o_orderkey = l_orderkey"
    ),
}
