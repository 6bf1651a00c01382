"""Lines that come before their dimensions: parked, placed later, never read again once placed."""

from landfall.plans.early_facts import Side, load_lines, parked_lines, place_parked, placed_lines

SIDES = (Side("erp.o", "ok", "lo", ("cust",)), Side("erp.c", "ck", "cust", ("land",)))
LINE = ("id", "lo")


def o(spark, *rows):
    return spark.createDataFrame(rows, "ok int, cust int")


def c(spark, *rows):
    return spark.createDataFrame(rows, "ck int, land string")


def lines(spark, *rows):
    return spark.createDataFrame(rows, "id int, lo int")


def state(store):
    placed = {(r.id, r.cust, r.land) for r in placed_lines(store, "dwh.f").collect()}
    return placed, {(r.id, r._missing) for r in parked_lines(store, "dwh.f").collect()}


def test_lines_are_parked_and_placed_when_their_sides_come(spark, store):
    store.append(o(spark, (1, 10)), "erp.o")
    store.append(c(spark, (10, "de")), "erp.c")
    load_lines(store, "dwh.f", lines(spark, (1, 1), (2, 2), (3, None), (4, 1), (4, 1)), SIDES)
    assert state(store) == ({(1, 10, "de"), (4, 10, "de")}, {(2, "erp.o"), (3, "erp.o")})
    assert placed_lines(store, "dwh.f").count() == 3  # a repeated line stays repeated
    assert place_parked(store, "dwh.f", LINE, SIDES) is None
    store.append(o(spark, (2, 20), (5, 10)), "erp.o")
    place_parked(store, "dwh.f", LINE, SIDES)  # the order has come, its customer has not
    assert state(store)[1] == {(2, "erp.c"), (3, "erp.o")}
    load_lines(store, "dwh.f", lines(spark, (6, 5), (7, 9)), SIDES)
    store.append(c(spark, (20, "fr")), "erp.c")
    made = place_parked(store, "dwh.f", LINE, SIDES)
    assert state(store) == (
        {(1, 10, "de"), (4, 10, "de"), (2, 20, "fr"), (6, 10, "de")},
        {(3, "erp.o"), (7, "erp.o")},
    )
    assert made.rows_written == 3 and made.metrics["parked"] == 2  # what was placed before is not written again
    assert placed_lines(store, "dwh.f").count() == 5
    assert place_parked(store, "dwh.f", LINE, SIDES) is None


def test_either_order_gives_the_same_fact(spark, store):
    sides = [("erp.o", o(spark, (1, 10), (2, 20))), ("erp.c", c(spark, (10, "de"), (20, None)))]
    rows = lines(spark, (1, 1), (2, 2), (3, 3))
    for name, table in sides:
        store.append(table, name)
    load_lines(store, "dwh.f", rows, SIDES)
    first = state(store)
    late = type(store)(spark, store.root + "/late")
    for name, table in sides:
        late.append(table.filter("1 = 0"), name)
    load_lines(late, "dwh.f", rows, SIDES)
    assert state(late) == (set(), {(1, "erp.o"), (2, "erp.o"), (3, "erp.o")})
    for name, table in sides:
        late.append(table, name)
        place_parked(late, "dwh.f", LINE, SIDES)
    assert state(late) == first


def test_dimensions_that_come_during_a_load_of_lines_are_tried_again(spark, store):
    store.append(o(spark, (1, 10)), "erp.o")
    store.append(c(spark, (10, "de")), "erp.c")
    load_lines(store, "dwh.f", lines(spark, (1, 2)), SIDES)
    store.append(o(spark, (2, 10)), "erp.o")
    load_lines(store, "dwh.f", lines(spark, (2, 2)), SIDES)  # meets the new order; the parked line has not
    assert state(store) == ({(2, 10, "de")}, {(1, "erp.o")})
    place_parked(store, "dwh.f", LINE, SIDES)
    assert state(store) == ({(1, 10, "de"), (2, 10, "de")}, set())


def test_placing_opens_parked_files_only(spark, store):
    store.append(o(spark, (1, 10)), "erp.o")
    store.append(c(spark, (10, "de")), "erp.c")
    load_lines(store, "dwh.f", lines(spark, (1, 1), (2, 2)), SIDES)
    files = parked_lines(store, "dwh.f").inputFiles()
    scanned = parked_lines(store, "dwh.f")._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [" in scanned and "_state" in scanned.split("PartitionFilters: [")[1].split("]")[0]
