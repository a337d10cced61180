"""Delimited dumps: all-text scans with a fixed column list, header contracts, scoped loads."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import missing_to_null
from ledgerline.operators.scope import reject_reason

#: Columns of the dump's files, in order.
DUMP = {
    "Processo": ("DSProcesso", "NRProcesso", "NRAnoProcesso", "BTAtivo", "NRNUP", "IDTipoRequerimento", "IDFaseProcesso", "IDUnidadeAdministrativaRegional", "IDUnidadeProtocolizadora", "DTProtocolo", "DTPrioridade", "QTAreaHA"),
    "ProcessoEvento": ("DSProcesso", "IDEvento", "DTEvento", "OBEvento", "DSPublicacaoDOU"),
    "Evento": ("IDEvento", "DSEvento"),
    "ProcessoMunicipio": ("DSProcesso", "IDMunicipio"),
    "Municipio": ("IDMunicipio", "NMMunicipio", "SGUF"),
    "ProcessoSubstancia": ("DSProcesso", "IDSubstancia", "IDTipoUsoSubstancia", "IDMotivoEncerramentoSubstancia", "DTInicioVigencia", "DTFimVigencia"),
    "Substancia": ("IDSubstancia", "NMSubstancia"),
    "ProcessoPessoa": ("DSProcesso", "IDPessoa", "IDTipoRelacao", "IDTipoResponsabilidadeTecnica", "IDTipoRepresentacaoLegal", "DTPrazoArrendamento", "DTInicioVigencia", "DTFimVigencia"),
    "Pessoa": ("IDPessoa", "NRCPFCNPJ", "TPPessoa", "NMPessoa"),
}


def text_scan(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """A delimited file with one header line, every column text, named by position; spellings of missing values are null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).csv(path, sep=sep, header=True, encoding=encoding, escape='"', quote='"', enforceSchema=True)
    return df.select(*[missing_to_null(F.col(c)).alias(c) for c in columns])


def header_contract(spark: SparkSession, folder: str, files: Mapping[str, Sequence[str]] = DUMP, sep: str = ";", suffix: str = ".txt") -> DataFrame:
    """arquivo, situacao, found and wanted column counts of each file's header.

    ``erro_colunas`` for another count, ``aviso_nomes`` for other names (case and byte order mark aside),
    ``ausente`` for a file that is not there.
    """
    # Only names are read of the folder, then one line of each wanted file: the limit ends its scan.
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    paths = spark.read.format("binaryFile").load(folder).select("path", name.alias("arquivo")).filter(F.col("arquivo").isin([k + suffix for k in files])).collect()
    heads = [spark.read.option("encoding", "ISO-8859-1").text(r["path"]).limit(1).select(F.lit(r["arquivo"]).alias("arquivo"), F.col("value").alias("cabecalho")) for r in paths]
    first = reduce(lambda a, b: a.unionByName(b), heads, spark.createDataFrame([], "arquivo string, cabecalho string"))
    wanted = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k + suffix).alias("arquivo"), F.lit(sep.join(v)).alias("esperado")) for k, v in files.items()])))
    j = wanted.join(first, "arquivo", "left")
    clean = lambda c: F.lower(F.regexp_replace(F.trim(c), "^(﻿|ï»¿)", ""))
    found, need = F.size(F.split("cabecalho", sep)), F.size(F.split("esperado", sep))
    state = F.when(F.col("cabecalho").isNull(), "ausente").when(found != need, "erro_colunas").when(clean(F.col("cabecalho")) != F.lower("esperado"), "aviso_nomes").otherwise("ok")
    return j.select("arquivo", F.when(F.col("cabecalho").isNotNull(), found).alias("colunas"), need.alias("esperadas"), state.alias("situacao"))


def scoped_load(fact: DataFrame, rules: Sequence[tuple[str, Column]], sample: int | None = None) -> tuple[DataFrame, Observation]:
    """(rows that no rule rejects, their counters) (S4, T4). Filters run with the scan; the sample takes any rows,
    as files have no order (O7).

    Counters are observed while the rows are read: whatever runs the rows, a write say, fills them, and nothing is
    scanned for them again. ``load_counts`` makes a table of them. A sample ends the scan early, and its counters with it.
    """
    seen = Observation(f"scoped_load_{uuid.uuid4().hex}")
    tagged = fact.withColumn("__why", reject_reason(rules))
    counted = [F.count("*").alias("read"), *[F.count_if(F.col("__why") == name).alias(name) for name, _ in rules], F.count_if(F.col("__why").isNull()).alias("kept")]
    kept = tagged.observe(seen, *counted).filter("__why is null").drop("__why")
    return (kept.limit(sample) if sample is not None else kept), seen


def load_counts(spark: SparkSession, seen: Observation) -> DataFrame:
    """motivo, n of a load that has run: rows by the reason that rejected them, ``aceito`` for those kept; reasons without rows are left out."""
    counts = dict(seen.get)
    rows = [("aceito" if k == "kept" else k, int(v)) for k, v in counts.items() if k != "read" and v]
    return spark.createDataFrame(rows, "motivo string, n bigint")
