"""Updates that rewrite only touched ranges, appends that happen once, and
runs that die between their steps."""
import datetime as dt
import os

import pytest

from arrears.operators import merge as mg
from arrears.plans import loads, runlog
from arrears.sources import batches, io, ranges, schemas

SCHEMA = "id_titulo long, plano int, data_atualizacao timestamp_ntz"
DAY = dt.datetime(2026, 8, 1)
AS_OF = dt.datetime(2026, 8, 17, 9, 0)


class Killed(BaseException):
    """Ends a job as a killed process does: nothing catches it."""


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def spec(**kw):
    base = dict(job="ProcT", source="cob.T", target="T", key=["id_titulo"], extract=loads.ID_OR_VERSION, maintain=loads.UPSERT, id_col="id_titulo",
                version_col="data_atualizacao", set_cols=["plano", "data_atualizacao"], key_width=100, target_schema=io.T.StructType.fromDDL(SCHEMA))
    return loads.TableLoad(**{**base, **kw})


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def logs(scratch):
    return {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}


def runs(spark, scratch):
    return runlog.run_status(spark.read.parquet(f"{scratch}/runs")) if os.path.exists(f"{scratch}/runs") else spark.createDataFrame([], runlog.RUN_SCHEMA)


def volumes(spark, scratch):
    return sorted((r.linhas_origem, r.linhas_inseridas, r.linhas_atualizadas) for r in spark.read.parquet(f"{scratch}/volumes").collect())


def state(spark, scratch, s):
    return sorted((r.id_titulo, r.plano) for r in ranges.read_current(spark, f"{scratch}/t", s.target_schema).collect())


def test_upsert_rewrites_only_its_ranges(spark, scratch):
    s, path = spec(), f"{scratch}/t"
    src = [(i, 1, DAY) for i in range(350)]
    assert s.run(spark, frame(spark, src), path, runs(spark, scratch), logs(scratch), AS_OF)["linhas_inseridas"] == 350
    before = files(path)
    changed = frame(spark, [(i, 1, DAY) for i in range(350) if i != 120] + [(120, 9, AS_OF), (402, 2, AS_OF)])
    c = s.run(spark, changed, path, runs(spark, scratch), logs(scratch), AS_OF + dt.timedelta(hours=1))
    assert c == {"linhas_origem": 2, "linhas_inseridas": 1, "linhas_atualizadas": 1, "linhas_totais_destino": 2}
    after = files(path)
    assert {f: m for f, m in after.items() if f in before} == before            # nothing is touched in place
    new = {f.split("/range=")[1].split("/")[0] for f in set(after) - set(before)}
    assert new == {"1", "4"}                                                      # only the two ranges are written, once
    assert state(spark, scratch, s) == sorted([(i, 1) for i in range(350) if i != 120] + [(120, 9), (402, 2)])
    again = s.run(spark, changed, path, runs(spark, scratch), logs(scratch), AS_OF + dt.timedelta(hours=2))
    assert again == {"linhas_origem": 0, "linhas_inseridas": 0, "linhas_atualizadas": 0, "linhas_totais_destino": 0}
    assert volumes(spark, scratch) == [(0, 0, 0), (2, 1, 1), (350, 350, 0)]


def test_only_touched_ranges_are_read(spark, scratch):
    s, path = spec(), f"{scratch}/t"
    s.run(spark, frame(spark, [(i, 1, DAY) for i in range(350)]), path, runs(spark, scratch), logs(scratch), AS_OF)
    t = s._range_table(spark, path)
    assert t.touched(frame(spark, [(5, 1, DAY), (399, 1, DAY), (None, 1, DAY)])) == [-1, 0, 3]
    held = t.read([0, 3, 9])
    assert held.count() == 150 and all("range=0" in f or "range=3" in f for f in held.inputFiles())


def test_a_run_killed_before_publishing_changes_nothing(spark, scratch, monkeypatch):
    s, path = spec(), f"{scratch}/t"
    first = [(i, 1, DAY) for i in range(250)]
    s.run(spark, frame(spark, first), path, runs(spark, scratch), logs(scratch), AS_OF)
    src = frame(spark, [*first[:-1], (249, 7, AS_OF), (300, 1, AS_OF)])

    def killed(self, state):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(ranges.RangeTable, "publish", killed)
        with pytest.raises(Killed):
            s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF)
    assert state(spark, scratch, s) == [(i, 1) for i in range(250)]
    assert s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF)["linhas_totais_destino"] == 2
    assert state(spark, scratch, s) == [(i, 1) for i in range(249)] + [(249, 7), (300, 1)]
    assert volumes(spark, scratch) == [(2, 1, 1), (250, 250, 0)]


def test_readers_during_a_publish_keep_the_old_table(spark, scratch):
    s, path = spec(), f"{scratch}/t"
    s.run(spark, frame(spark, [(1, 1, DAY), (150, 1, DAY)]), path, runs(spark, scratch), logs(scratch), AS_OF)
    reader = ranges.read_current(spark, path, s.target_schema)
    s.run(spark, frame(spark, [(1, 5, AS_OF), (150, 1, DAY)]), path, runs(spark, scratch), logs(scratch), AS_OF)
    assert sorted((r.id_titulo, r.plano) for r in reader.collect()) == [(1, 1), (150, 1)]
    assert state(spark, scratch, s) == [(1, 5), (150, 1)]
    s.run(spark, frame(spark, [(1, 6, AS_OF + dt.timedelta(days=1))]), path, runs(spark, scratch), logs(scratch), AS_OF)
    t = s._range_table(spark, path)
    assert t.sweep() == 1 and state(spark, scratch, s) == [(1, 6), (150, 1)]     # the first folder of range 0 goes


def test_an_update_killed_before_its_log_is_logged_once(spark, scratch, monkeypatch):
    s, path = spec(), f"{scratch}/t"
    src = frame(spark, [(1, 1, DAY), (150, 1, DAY)])

    def killed(*a):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(runlog, "log_volume", killed)
        with pytest.raises(Killed):
            s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF)
    assert state(spark, scratch, s) == [(1, 1), (150, 1)] and not os.path.exists(f"{scratch}/volumes")
    for _ in range(2):
        s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF + dt.timedelta(hours=1))
    assert volumes(spark, scratch) == [(0, 0, 0), (0, 0, 0), (2, 2, 0)]
    assert [r.status_execucao for r in runs(spark, scratch).collect()] == ["Concluida"] * 3


@pytest.mark.parametrize("width", [None, 100])
@pytest.mark.parametrize("at", ["write_text", "finish", "half", "log"])
def test_an_append_that_dies_comes_once(spark, scratch, monkeypatch, at, width):
    """Killed before its ledger, before its files are moved, between two files, or before the log row."""
    s = spec(extract=loads.HIGH_WATER, maintain=loads.INSERT_ONLY, key_width=None, range_width=width, counts_extract=True,
             target_schema=io.T.StructType.fromDDL(SCHEMA + (", part long" if width else "")))
    path = f"{scratch}/t"
    src = frame(spark, [(i, 1, DAY) for i in range(1, 301)] + [(300, 1, AS_OF)]).repartition(4)   # a key twice in one batch: both rows go in (D22)

    def killed(*a, **k):
        raise Killed
    real = batches.finish

    def half(sp, p, run):
        moved = {f for f in files(p)}
        fs = ranges._path(sp, p)[1]
        rename, n = fs.rename, 0
        assert moved and rename
        jpath = sp._jvm.org.apache.hadoop.fs.Path
        one = sorted(f for f in moved if f"/{batches.FOLDER}/" in f)[0]
        inside = one.split("/rows/")[1]
        target = f"{p}/{os.path.dirname(inside)}".rstrip("/")
        fs.mkdirs(jpath(target))
        fs.rename(jpath(one), jpath(f"{target}/{run}-{os.path.basename(inside)}"))
        raise Killed
    with monkeypatch.context() as m:
        if at == "write_text":
            m.setattr(batches, "write_text", killed)
        elif at == "log":
            m.setattr(runlog, "log_volume", killed)
        else:
            m.setattr(batches, "finish", killed if at == "finish" else half)
        with pytest.raises(Killed):
            s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF)
    assert real is batches.finish
    s.run(spark, src, path, runs(spark, scratch), logs(scratch), AS_OF + dt.timedelta(hours=1))
    got = spark.read.parquet(path)
    assert got.count() == 301 and got.select("id_titulo").distinct().count() == 300
    want = [(301, 301, 0)] if at == "write_text" else [(0, 0, 0), (301, 301, 0)]
    assert volumes(spark, scratch) == want
    assert batches.open_batches(spark, path) == {}
    states = sorted(r.status_execucao for r in runs(spark, scratch).collect())
    assert states == (["Concluida", "Executando"] if at == "write_text" else ["Concluida"] * 2)


def test_source_rows_are_counted_after_c1(spark):
    """A10: the extract without the rows held in the same version; contact loads count their extract."""
    t = frame(spark, [(1, 1, DAY), (2, 1, DAY), (3, 1, None)])
    src = frame(spark, [(1, 1, DAY), (2, 2, AS_OF), (3, 1, None), (4, 1, None)])
    row = spec().volumes(src, t, watermark=dt.date(2026, 1, 1)).first()
    assert tuple(row) == (2, 1, 1, 2)
    contact = spec(maintain=loads.INSERT_ONLY, extract=loads.FULL_ABSENT, key_width=None)
    assert tuple(contact.volumes(src, t).first()) == (1, 1, 0, 1)
    counted = spec(maintain=loads.INSERT_ONLY, extract=loads.FULL_ABSENT, key_width=None, counts_extract=True)
    assert tuple(counted.volumes(src, t).first()) == (4, 1, 0, 1)


def test_info_extract_drops_rows_held_in_the_same_version(spark):
    """C2 of L10: NULL versions are equal; a NULL and the sentinel date are not."""
    s = loads.LOADS_BY_JOB["ProcParcelasInformacoesComplementares"]
    info = schemas.schema("parcelas_info")
    row = lambda k, v: (k, None, None, v, None, 1, dt.date(2026, 8, 1), None, None)
    src = spark.createDataFrame([row(1, None), row(2, AS_OF), row(3, None), row(4, dt.datetime(1900, 1, 1))], info)
    held = spark.createDataFrame([row(1, None), row(2, DAY), row(4, None)], info)
    parcelas = spark.createDataFrame([(1, "A", None)], "id_parcela int, id_situacao_parcela string, data_atualizacao timestamp_ntz")
    got = s.staged(src, held, watermark=dt.date(2026, 8, 1), inputs={"parcelas": parcelas})
    assert sorted(r.id_parcela_informacao_complementar for r in got.collect()) == [2, 3, 4]
    marked = s.plan(src, held, watermark=dt.date(2026, 8, 1), inputs={"parcelas": parcelas})
    assert {r.id_parcela_informacao_complementar: r.acao for r in marked.collect()} == {1: "N", 2: "U", 3: "I", 4: "N"}   # C1 in the update
    assert mg.INSERTED == "I"
