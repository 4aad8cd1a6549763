"""A warehouse day: the 25 loads, Base, Base360 and the marts in the order of
what they read, resumable after a failure (R1, W3).

``Day.run`` does the jobs that have not finished today; a day that stopped is run
again and goes on where it stopped.  That a finished job is not repeated matters
for results too: L12-L14 read the log of ``ProcAcordos`` back to its last run
but one, so a second run of it on the same day would cut off their extract.  The
agreements those three look at are staged once and read by all of them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.operators import incremental as inc
from arrears.plans import jobs, loads, marts, runlog, snapshot
from arrears.sources import io, ranges, schemas

#: What a job waits for, by what it reads; loads not named here read their source only.
AFTER = {
    "ProcAcordosParcelasPagar": ["ProcAcordos"], "AcordosParcelasNegociadas": ["ProcAcordos"], "AcordosInformacoesComplementares": ["ProcAcordos"],
    "ProcBase": ["ProcTitulos", "ProcDevedores", "ProcTitulosInformacoesComplementares", "ProcEscob", "ProcPropensao", "ProcParcelas",
                 "ProcParcelasInformacoesComplementares", "Carteiras", "ProcProdutos"],
    "ProcBase360": ["ProcBase"], "OrigemAcordos": ["ProcOcorrencias", "ProcLigacoes"], "ProcMailing": [],
    "ProcBaseMailing360": ["ProcBase360", "ProcMailing", "Carteiras"],
    "ProcCRM360": ["ProcBase360", "ProcEventos", "ProcOcorrencias", "ProcLigacoes", "ProcUsuarios", "ProcTiposEventos", "ProcTiposOcorrencias"],
    "ProcDiscador360": ["ProcBase360"], "ProcDiscadorDigital360": ["ProcBase360"],
    **dict.fromkeys(("ProcPagamentos360", "ProcVencimentos360"),
                    ["ProcBase360", "ProcUsuarios", "ProcAcordos", "ProcAcordosParcelasPagar", "AcordosParcelasNegociadas", "ProcStatusAcordos", "ProcTiposAcordos", "OrigemAcordos"]),
}


def ordered(names: list[str], after: dict[str, list[str]]) -> list[str]:
    """Names so that each comes after what it waits for."""
    out: list[str] = []

    def add(name: str, above: tuple[str, ...] = ()) -> None:
        if name in above:
            raise ValueError(f"{name} waits for itself")
        for x in after.get(name, []):
            add(x, (*above, name))
        if name not in out:
            out.append(name)
    for name in names:
        add(name)
    return [x for x in out if x in names]


@dataclass
class Day:
    """``sources``: the loads' source tables by target name, and ``mailing``,
    ``promessas``, ``discador`` and ``discador_digital``; ``root``: the
    warehouse folder; ``as_of``: the clock."""

    spark: SparkSession
    root: str
    sources: dict[str, DataFrame]
    as_of: _dt.datetime

    @property
    def log_paths(self) -> dict[str, str]:
        return {k: f"{self.root}/log/{k}" for k in ("runs", "volumes", "errors")}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, target: str) -> DataFrame:
        spec = next(s for s in loads.LOADS if s.target == target)
        schema = schemas.schema(schemas.TABLES[target])
        if spec.range_width:
            schema = schema.add("part", "long")
        return ranges.read_current(self.spark, self.path(target), schema).drop("part")

    def run_log(self) -> DataFrame:
        rows = (self.spark.read.schema(runlog.RUN_SCHEMA).parquet(self.log_paths["runs"]) if io.exists(self.spark, self.log_paths["runs"])
                else self.spark.createDataFrame([], runlog.RUN_SCHEMA))
        return runlog.run_status(rows)

    def finished(self) -> set[str]:
        """Jobs that have ended well today (at most as many as there are jobs)."""
        today = (F.col("status_execucao") == inc.DONE) & (F.to_date("data_hora_inicio") == X.date_lit(self.as_of))
        return {r[0] for r in self.run_log().where(today).select("nome_procedure").distinct().collect()}

    def scope(self) -> DataFrame:
        """The agreements of L12-L14, staged once a day."""
        path = f"{self.root}/_scope/{self.as_of:%Y-%m-%d}"
        if not _committed(self.spark, path):
            watermark = inc.watermark_of(self.run_log(), "ProcAcordos", "penultimate")
            scope = loads.agreement_scope(self.sources["Acordos"], self.sources["AcordosParcelasPagar"], watermark, self.as_of)
            scope.distinct().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    # -- jobs --------------------------------------------------------------
    def _load(self, spec: loads.TableLoad) -> dict:
        inputs = {"parcelas": self.sources.get("Parcelas"), "acordos": self.sources.get("Acordos"), "parcelas_pagar": self.sources.get("AcordosParcelasPagar")}
        if spec.watermark_job:
            inputs["escopo"] = self.scope()
        return spec.run(self.spark, self.sources[spec.target], self.path(spec.target), self.run_log(), self.log_paths, self.as_of,
                        inputs={k: v for k, v in inputs.items() if v is not None})

    def _mart(self, job: str, source: str, target: str, body: Callable[[str], dict]) -> dict:
        return jobs.run(self.spark, job, source, target, self.path(target), self.log_paths, self.as_of, body)

    def base(self) -> dict:
        t = self.table
        open_ = snapshot.open_instalments(t("Parcelas"), self.as_of, t("ParcelasInformacoesComplementares"))
        rows = snapshot.base_snapshot(open_, t("Titulos"), t("Devedores"), t("Carteiras"), t("TitulosInformacoesComplementares"), t("Escob"), t("Propensao"), t("Produtos"))
        return self._mart("ProcBase", "dbo.Parcelas", "Base", lambda run: snapshot.run_base(self.spark, self.path("Base"), rows))

    def base360(self) -> dict:
        base = self.spark.read.parquet(self.path("Base"))
        return self._mart("ProcBase360", "dbo.Base", "Base360", lambda run: snapshot.run_base360(self.spark, self.path("Base360"), base, self.as_of).first().asDict())

    def _snapshot(self) -> DataFrame:
        return self.spark.read.parquet(self.path("Base360"))

    def mailing(self) -> dict:
        s = self.sources
        return self._mart("ProcMailing", "log.Mailing", "Mailing", lambda run: jobs.mailing(
            self.spark, self.path("Mailing"), s["mailing"], s["Parcelas"], s["Titulos"], s["Ocorrencias"], s["promessas"], self.as_of, run))

    def base_mailing(self) -> dict:
        held = ranges.read_current(self.spark, self.path("Mailing"), io.T.StructType.fromDDL("id_devedor bigint, id_carteira int, id_retirada int"))
        return self._mart("ProcBaseMailing360", "dbo.Mailing", "BaseMailing360", lambda run: jobs.mailing_attach(
            self.spark, self.path("BaseMailing360"), self._snapshot(), held, self.table("Carteiras"), self.as_of, run))

    def channels(self) -> dict:
        return self._mart("OrigemAcordos", "dbo.Ocorrencias", "OrigemAcordos", lambda run: jobs.agreement_channels(
            self.spark, self.path("OrigemAcordos"), self.table("Ocorrencias"), self.table("Ligacoes"), run))

    def _today(self, job: str, source: str, target: str, staged: DataFrame, keys: list[str]) -> dict:
        return self._mart(job, source, target, lambda run: jobs.append_absent(
            self.spark, self.path(target), staged.withColumn("dia", F.to_date("data")), keys, run, "dia", F.col("dia") >= X.date_lit(self.as_of)))

    def crm(self) -> dict:
        t = self.table
        contacts = marts.crm_contacts(t("Ocorrencias"), t("Eventos"), t("TiposOcorrencias"), t("TiposEventos"), t("Ligacoes"), t("Usuarios"), self.as_of)
        return self._today("ProcCRM360", "dbo.Ocorrencias", "CRM360", marts.crm_final(contacts, self._snapshot(), self.as_of), ["id_base", "data"])

    def dialer(self) -> dict:
        calls = marts.attach_calls(marts.read_dialer(self.sources["discador"], self.as_of), self._snapshot(), self.as_of, marts.DIALER_DURATIONS)
        return self._today("ProcDiscador360", "CallDialer", "Discador360", calls, marts.CALL_KEY)

    def digital_dialer(self) -> dict:
        calls = marts.attach_calls(marts.read_digital(self.sources["discador_digital"], self.as_of), self._snapshot(), self.as_of, marts.DIGITAL_DURATIONS)
        return self._today("ProcDiscadorDigital360", "CallDigital", "DiscadorDigital360", calls, marts.CALL_KEY)

    def _star(self) -> list[DataFrame]:
        channels = self.spark.read.parquet(self.path("OrigemAcordos"))
        return [*(self.table(x) for x in ("Acordos", "TiposAcordos", "AcordosParcelasNegociadas", "AcordosParcelasPagar", "Usuarios", "StatusAcordos")), channels]

    def payments(self) -> dict:
        return self._mart("ProcPagamentos360", "dbo.AcordosParcelasPagar", "Pagamentos360",
                          lambda run: jobs.payments(self.spark, self.path("Pagamentos360"), self._star(), self._snapshot(), run))

    def due(self) -> dict:
        return self._mart("ProcVencimentos360", "dbo.AcordosParcelasPagar", "Vencimentos360",
                          lambda run: jobs.due(self.spark, self.path("Vencimentos360"), self._star(), self._snapshot(), self.as_of, run))

    def jobs(self) -> dict[str, Callable[[], dict]]:
        out = {s.job: (lambda s=s: self._load(s)) for s in loads.LOADS if s.target in self.sources}
        out |= {"ProcBase": self.base, "ProcBase360": self.base360, "ProcMailing": self.mailing, "ProcBaseMailing360": self.base_mailing,
                "OrigemAcordos": self.channels, "ProcCRM360": self.crm, "ProcDiscador360": self.dialer, "ProcDiscadorDigital360": self.digital_dialer,
                "ProcPagamentos360": self.payments, "ProcVencimentos360": self.due}
        return out

    def run(self, only: list[str] | None = None) -> dict[str, dict]:
        """Run the jobs (or those named) that have not finished today, in order; returns their counts."""
        todo, done = self.jobs(), self.finished()
        return {name: todo[name]() for name in ordered(only or list(todo), AFTER) if name not in done}


def _committed(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
