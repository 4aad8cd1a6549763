"""One warehouse day on the driver tables: a table load, the snapshot and a
fact mart, each as a logged job writing Parquet tables under one folder.

    python examples/daily_run.py /root/testdata/sf0.01 /path/to/warehouse 2024-01-15T12:00:00

Order follows the job dependencies (loads -> Base -> Base360 -> marts).
Re-running a day inserts and updates nothing.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from arrears.functions import derive as X  # noqa: E402
from arrears.plans import loads, marts, runlog, snapshot  # noqa: E402
from arrears.sources import io  # noqa: E402
from arrears.sources import standins as S  # noqa: E402

OCCURRENCE_RANGE = 1_000


def run_day(spark, sf_dir: str, wh: str, as_of: dt.datetime) -> dict:
    t = S.DriverTables(spark, sf_dir)
    logs = {k: f"{wh}/log/{k}" for k in ("runs", "volumes", "errors")}
    out = {}

    # L16 occurrences: insert-only by id (else by date), range-partitioned target.
    occ = S.ocorrencias(t).filter(F.col("data_ocorrencia") <= X.ts_lit(as_of))
    occ_path = f"{wh}/ocorrencias"
    occ_schema = occ.withColumn("part", io.key_range("id_ocorrencia", 1)).schema
    spec = loads.TableLoad("ProcOcorrencias", "oco.Ocorrencias", "Ocorrencias", ["id_ocorrencia"],
                           loads.ID_OR_DATE, loads.INSERT_ONLY, id_col="id_ocorrencia",
                           date_col="data_ocorrencia", watermark_form="forward", range_width=OCCURRENCE_RANGE,
                           target_schema=occ_schema)
    runs = (runlog.run_status(spark.read.parquet(logs["runs"])) if io.exists(spark, logs["runs"])
            else None)
    out["ocorrencias"] = spec.run(spark, occ, occ_path, runs, logs, as_of)

    # M1 + M2: Base of the day applied to Base360 (only today's partition rewritten).
    base = snapshot.base_snapshot(
        snapshot.open_instalments(S.parcelas(t), as_of), S.titulos(t), S.devedores(t), S.carteiras(t),
        titulos_info=S.titulos_info(t), escob=S.escob(t), propensao=S.propensao(t))
    base_path, b360 = f"{wh}/base", f"{wh}/base360"

    def base_job(set_stage):
        set_stage("Persistencia final")
        return snapshot.run_base(spark, base_path, base)

    out["base"] = runlog.logged_run(spark, "ProcBase", "ods.Parcelas", "Base", logs, as_of, base_job)

    def base360_job(set_stage):
        set_stage("Persistencia final")
        return snapshot.run_base360(spark, b360, spark.read.parquet(base_path), as_of).first().asDict()

    out["base360"] = runlog.logged_run(spark, "ProcBase360", "ods.Base", "Base360", logs, as_of,
                                       base360_job)

    # M4: contacts of the day attached to today's snapshot, appended when absent.
    ocorrencias = spark.read.schema(spec.target_schema).parquet(occ_path).drop("part")
    contacts = marts.crm_contacts(ocorrencias, S.eventos(t).filter(F.col("data_evento") <= X.ts_lit(as_of)),
                                  S.tipos_ocorrencias(t), S.tipos_eventos(t), S.ligacoes(t), S.usuarios(t), as_of)
    staged = marts.crm_final(contacts, spark.read.parquet(b360), as_of).withColumn("dia", F.to_date("data"))

    def crm_job(set_stage):
        set_stage("Persistencia final")
        n = marts.append_new(spark, f"{wh}/crm360", staged, ["id_base", "data"], "dia",
                             scope=F.col("dia") >= X.date_lit(as_of))
        return {"linhas_inseridas": n}

    out["crm360"] = runlog.logged_run(spark, "ProcCRM360", "Ocorrencias/Eventos", "CRM360", logs, as_of, crm_job)

    # M5: the dialer's calls of the day (remote extract, S3) on today's snapshot.
    calls = marts.attach_calls(marts.read_dialer(S.dialer_source(t).filter(
        F.col("inicio_discagem") <= X.ts_lit(as_of)), as_of), spark.read.parquet(b360), as_of,
        marts.DIALER_DURATIONS).withColumn("dia", F.to_date("data"))

    def dialer_job(set_stage):
        set_stage("Persistencia final")
        n = marts.append_new(spark, f"{wh}/discador360", calls, marts.CALL_KEY, "dia",
                             scope=F.col("dia") >= X.date_lit(as_of))
        return {"linhas_inseridas": n}

    out["discador360"] = runlog.logged_run(spark, "ProcDiscador360", "remote.CallDialer", "Discador360", logs,
                                           as_of, dialer_job)
    return out


if __name__ == "__main__":
    from arrears.session import build_session
    sf, wh, day = sys.argv[1], sys.argv[2], dt.datetime.fromisoformat(sys.argv[3])
    print(run_day(build_session(), sf, wh, day))
