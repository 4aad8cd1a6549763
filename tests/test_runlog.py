"""Run log, volumes and purge."""
import datetime as dt

from arrears.plans import runlog

from conftest import rows

CFG = "id_tabela_expurgo int, nome_tabela string, hora_expurgo string"
DONE = "id_tabela_expurgo int, nome_tabela string, data_execucao timestamp_ntz"
AS_OF = dt.datetime(2026, 8, 17, 10, 0)


def test_purge_due(spark):
    cfg = spark.createDataFrame([(1, "a", "09:00:00"), (2, "b", "09:00:00"), (3, "c", "09:00:00"),
                                 (4, "d", "11:00:00")], CFG)
    done = spark.createDataFrame([(2, "b", dt.datetime(2026, 8, 17, 9, 5)),
                                  (3, "c", dt.datetime(2026, 8, 16, 9, 5))], DONE)
    assert rows(runlog.purge_due(cfg, done, AS_OF), "id_tabela_expurgo") == [(1,), (3,)]


def test_run_purge_calls_each_due_table_once(spark):
    cfg = spark.createDataFrame([(1, "a", "09:00:00"), (4, "d", "11:00:00")], CFG)
    done = spark.createDataFrame([], DONE)
    purged = []
    log = runlog.run_purge(spark, cfg, done, AS_OF, purged.append)
    assert purged == ["a"] and rows(log, "nome_tabela") == [("a",)]


def test_run_states_and_duration(spark):
    rid, opened = runlog.start_run(spark, "ProcX", AS_OF)
    closed = runlog.finish_run(spark, rid, "ProcX", AS_OF, AS_OF + dt.timedelta(seconds=75), ok=True)
    rid2, opened2 = runlog.start_run(spark, "ProcY", AS_OF)
    st = {r.id_execucao: (r.status_execucao, r.tempo_execucao_segundos)
          for r in runlog.run_status(opened.unionByName(closed).unionByName(opened2)).collect()}
    assert st[rid] == ("Concluida", 75) and st[rid2] == ("Executando", None)


def test_volume_row_nulls_to_zero(spark):
    v = runlog.log_volume(spark, "r", "src", "dst", {"linhas_inseridas": None, "linhas_atualizadas": 3}, AS_OF)
    r = v.first()
    assert (r.linhas_origem, r.linhas_inseridas, r.linhas_atualizadas, r.linhas_totais_destino) == (0, 0, 3, 3)


def test_error_row(spark):
    try:
        raise ValueError("boom")
    except ValueError as e:
        r = runlog.log_error(spark, "r", "ProcX", "Carga", e, AS_OF).first()
    assert r.etapa_erro == "Carga" and "boom" in r.mensagem_erro


def test_logged_run_around_a_mart(spark, scratch):
    from arrears.plans import marts
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    staged = spark.createDataFrame([(1, dt.date(2026, 8, 17), "a")], "id_base long, dia date, x string")

    def body(set_stage):
        set_stage("Persistencia final")
        return {"linhas_origem": staged.count(),
                "linhas_inseridas": marts.append_new(spark, f"{scratch}/mart", staged, ["id_base"], "dia")}

    c = runlog.logged_run(spark, "ProcCRM360", "ods.Ocorrencias", "CRM360", logs, AS_OF, body)
    assert c["linhas_inseridas"] == 1
    v = spark.read.parquet(logs["volumes"]).first()
    assert (v.linhas_origem, v.linhas_inseridas, v.linhas_totais_destino) == (1, 1, 1)

    def failing(set_stage):
        set_stage("Atualizacao de dados")
        raise RuntimeError("disk full")

    try:
        runlog.logged_run(spark, "ProcCRM360", "ods.Ocorrencias", "CRM360", logs, AS_OF, failing)
    except RuntimeError:
        pass
    e = spark.read.parquet(logs["errors"]).first()
    assert e.etapa_erro == "Atualizacao de dados" and "disk full" in e.mensagem_erro
    st = sorted(r.status_execucao for r in runlog.run_status(spark.read.parquet(logs["runs"])).collect())
    assert st == ["Concluida", "Erro"]
