"""Past months of the log in one file each, for readers the same log."""

from landfall.tables import audit


def _months(store, monkeypatch, months):
    ids = iter(f"{m}01T000000000000Z-{i:012d}-x" for i, m in enumerate(months))
    monkeypatch.setattr("landfall.tables.store.new_load_id", lambda: next(ids))


def _log(store):
    return sorted(map(str, store.audit("s.t").collect()))


def test_folded_months_read_as_before(spark, store, monkeypatch):
    _months(store, monkeypatch, ["209901", "209901", "209901", "209902", "209903", "209904"])
    store.refresh(spark.range(1), "s.t")
    for low in (1, 2, 3, 4):
        store.append(spark.range(low, low + 1), "s.t")
    rows, log = sorted(r.id for r in store.read("s.t").collect()), _log(store)
    whole = store.audit().count()
    assert store.fold_log("s.t") == ["209903", "209902", "209901"]
    assert rows == sorted(r.id for r in store.read("s.t").collect()) == [0, 1, 2, 3, 4]
    assert _log(store) == log and store.audit().count() == whole == 5
    files = store.audit("s.t").inputFiles()
    assert len(files) == 3 and all("_audit_folded" in f for f in files)


def test_the_month_under_way_stays(spark, store):
    store.refresh(spark.range(1), "s.t")
    assert store.fold_log("s.t") == [] and store.fold_log("s.none") == []


def test_a_late_row_is_read_and_folded_again(spark, store, monkeypatch):
    _months(store, monkeypatch, ["209901", "209901", "209902", "209901", "209902"])
    store.refresh(spark.range(1), "s.t")
    store.append(spark.range(1, 2), "s.t")
    assert store.fold_log("s.t") == ["209901"]
    store.append(spark.range(2, 3), "s.t")  # a load that began in the folded month
    assert sorted(r.id for r in store.read("s.t").collect()) == [0, 1, 2]
    assert store.fold_log("s.t") == ["209901"]
    assert len(_log(store)) == 3 and len(store.audit("s.t").inputFiles()) == 1


def test_an_entry_that_is_not_committed_is_never_folded_away(spark, store, monkeypatch):
    _months(store, monkeypatch, ["209901", "209901", "209902", "209902"])
    store.refresh(spark.range(1), "s.t")
    folder = f"{store.audit_path}/s.t/209901/under-way"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    assert audit.fold_audit(spark, store.audit_path, "s.t", "209902") == []
    store.append(spark.range(1, 2), "s.t")
    assert len(_log(store)) == 2
