"""Legacy tables read straight from the legacy databases over JDBC.

Drop-in replacement for ``Legacy`` when the source is the live back office instead of test tables:
each legacy name maps to ``<ENTITY>_<DB>.dbo.<table>``; column names are lower-cased so the jobs see
the same names as with the adapters. Large tables are read in parallel slices of an integer key
(``partitionColumn`` / ``numPartitions``), so no single connection streams a whole table.
Credentials come from the caller (Spark options or a secret store), never from this code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import is_planning
from .catalog import Catalog

# legacy name used by the jobs -> (database, table)
LEGACY_TABLES: dict[str, tuple[str, str]] = {
    "unidademedida": ("ALMOX", "UnidadeMedida"),
    "classificacao": ("ALMOX", "classificacao"),
    "classificacao_bens": ("ALMOX", "classificacao_bens"),
    "classificacao_obras": ("ALMOX", "classificacao_obras"),
    "produto": ("ALMOX", "produto"),
    "almoxarifado": ("ALMOX", "almoxarifado"),
    "fornecedor": ("ALMOX", "fornecedor"),
    "enderecofornecedor": ("ALMOX", "enderecofornecedor"),
    "municipio": ("ALMOX", "municipio"),
    "unidadefederacao": ("ALMOX", "unidadefederacao"),
    "contacorrentefornecedor": ("ALMOX", "contacorrentefornecedor"),
    "almox_movimento": ("ALMOX", "movimento"),
    "almox_movimento_linhas": ("ALMOX", "movimento"),
    "logradouro": ("ALMOX", "logradouro"),
    "integrainstrumentopedido": ("ALMOX", "INTEGRAINSTRUMENTOPEDIDO"),
    "orgao": ("COMPRAS", "ORGAO"),
    "processopesquisa": ("COMPRAS", "processopesquisa"),
    "itempesquisa": ("COMPRAS", "itempesquisa"),
    "orgaopesquisa": ("COMPRAS", "orgaopesquisa"),
    "condicaopagamento": ("COMPRAS", "condicaopagamento"),
    "propostapesquisa": ("COMPRAS", "propostapesquisa"),
    "processolicitatorio": ("COMPRAS", "processolicitatorio"),
    "itemobjeto": ("COMPRAS", "itemobjeto"),
    "tender_proposta": ("COMPRAS", "proposta"),
    "classificacaoproposta": ("COMPRAS", "classificacaoproposta"),
    "tabela_preco_item": ("COMPRAS", "TABELA_PRECO_ITEM"),
    "dataview_pedidoempenho": ("COMPRAS", "dataview_pedidoempenho"),
    "instrumentocontratual": ("COMPRAS", "instrumentocontratual"),
    "iteminstrumentocontratual": ("COMPRAS", "iteminstrumentocontratual"),
    "instrumento_contratual_empenho": ("COMPRAS", "instrumento_contratual_empenho"),
    "localentrega": ("COMPRAS", "localentrega"),
    "itemdespesa": ("COMPRAS", "ITEMDESPESA"),
    "despesa": ("COMPRAS", "DESPESA"),
    "motorista": ("FROTAS", "motorista"),
    "frotas_veiculo": ("FROTAS", "veiculo"),
    "tipoveiculo": ("FROTAS", "tipoveiculo"),
    "movtoveiculo": ("FROTAS", "movtoveiculo"),
    "patri_classificacao": ("PATRI", "classificacao"),
    "patri_item": ("PATRI", "item"),
    "localizacao": ("PATRI", "localizacao"),
    "estadoconservacao": ("PATRI", "estadoconservacao"),
    "tipobaixa": ("PATRI", "tipobaixa"),
    "patri_movimento": ("PATRI", "movimento"),
    "movimentodepreciacao": ("PATRI", "movimentodepreciacao"),
    "movimentovlcomplementar": ("PATRI", "movimentovlcomplementar"),
    "motivo": ("PATRI", "motivo"),
    "ppaplanoconta": ("PPA", "ppaplanoconta"),
}

# Integer key to slice big tables on: table -> column.
SLICE_KEYS: dict[str, str] = {
    "almox_movimento": "nrlancamento",
    "patri_movimento": "cditem",
    "movimentodepreciacao": "cditem",
    "classificacaoproposta": "nrprocesso",
    "dataview_pedidoempenho": "nrempenho",
    "propostapesquisa": "nrpesquisa",
    "itempesquisa": "nrpesquisa",
    "movtoveiculo": "nrsequencia",
    "movimentovlcomplementar": "cditem",
    "processopesquisa": "nrpesquisa",
    "processolicitatorio": "nrprocesso",
    "itemobjeto": "nrprocesso",
    "tender_proposta": "nrprocesso",
    "produto": "cdmaterial",
}


@dataclass
class JdbcLegacy(Catalog):
    """Legacy tables of one entity over JDBC; ``targets`` holds pre-existing target tables
    (existing suppliers, commitments, tender sessions, cost centres, ...) as DataFrames supplied by the caller."""

    spark: SparkSession
    url: str
    entity: str
    options: dict[str, str] = field(default_factory=dict)
    targets: dict[str, DataFrame] = field(default_factory=dict)
    rows_per_slice: int = 500_000

    def __post_init__(self):
        super().__init__(self.spark)

    def dbtable(self, name: str) -> str:
        db, table = LEGACY_TABLES[name]
        return f"{self.entity.upper()}_{db}.dbo.{table}"

    def _bounds(self, dbtable: str, col: str) -> tuple[int, int, int]:
        # One tiny query per sliced table: the key range, so the slices cover it evenly, and the row count.
        row = (self.spark.read.format("jdbc").options(**self.options).option("url", self.url)
               .option("query", f"select min({col}) lo, max({col}) hi, count(*) n from {dbtable}").load().first())
        return int(row["lo"] or 0), int(row["hi"] or 0), int(row["n"] or 0)

    def read(self, name: str) -> DataFrame:
        if name in self.targets:
            return self.targets[name]
        dbtable = self.dbtable(name)
        reader = self.spark.read.format("jdbc").options(**self.options).option("url", self.url).option("dbtable", dbtable)
        key = SLICE_KEYS.get(name)
        if key and not is_planning():
            lo, hi, n = self._bounds(dbtable, key)
            reader = reader.option("partitionColumn", key).option("lowerBound", lo) \
                .option("upperBound", hi + 1).option("numPartitions", max(1, -(-n // self.rows_per_slice)))
        df = reader.load()
        return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
