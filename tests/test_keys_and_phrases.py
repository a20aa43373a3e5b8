"""Changes of keys through all references, phrases, and the upkeep of a stored index."""

import pytest

from martlake.operators import quality, textindex


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def shop(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return {
        "film": make([(1, "A"), (2, "B")], "film_id int, title string"),
        "film_actor": make([(5, 1), (5, 2)], "actor_id int, film_id int"),
        "inventory": make([(10, 1), (11, 2), (12, None)], "inventory_id int, film_id int"),
        "rental": make([(100, 10), (101, 11)], "rental_id int, inventory_id int"),
        "payment": make([(1000, 100), (1001, 101)], "payment_id int, rental_id int"),
    }


def test_keys_follow_through_all_children(spark, shop):
    change = spark.createDataFrame([(1, 71), (9, 99)], "old int, new int")
    moved = quality.cascade_keys(shop, {"film": change, "rental": spark.createDataFrame([(101, 555)], "old int, new int")})
    assert rows(moved["film"]) == [(2, "B"), (71, "A")]
    assert rows(moved["film_actor"]) == [(5, 2), (5, 71)]
    assert sorted(moved["inventory"].collect(), key=str) == sorted([(10, 71), (11, 2), (12, None)], key=str)
    assert rows(moved["rental"]) == [(100, 10), (555, 11)]
    assert rows(moved["payment"]) == [(1000, 100), (1001, 555)]
    # Keys may change places in one go.
    swapped = quality.cascade_keys(shop, {"film": spark.createDataFrame([(1, 2), (2, 1)], "old int, new int")})
    assert rows(swapped["film"]) == [(1, "B"), (2, "A")] and rows(swapped["film_actor"]) == [(5, 1), (5, 2)]


@pytest.mark.parametrize("change", [[(1, 2)], [(1, 7), (1, 8)]])
def test_keys_that_meet_stop_the_change(spark, shop, change):
    with pytest.raises(ValueError):
        quality.cascade_keys(shop, {"film": spark.createDataFrame(change, "old int, new int")})


def test_composite_keys_are_changed_from_their_parents(spark, shop):
    with pytest.raises(ValueError, match="several columns"):
        quality.cascade_keys(shop, {"film_actor": spark.createDataFrame([(5, 6)], "old int, new int")})


def test_references_that_restrict(spark, shop):
    found = quality.restrict_keys(shop, "film", shop["film"].filter("film_id = 1"))
    assert rows(found) == [(1, "film_actor", "film_id"), (1, "inventory", "film_id")]


TEXTS = [
    (1, "new york new york city"),
    (2, "york new"),
    (3, "bank of england of the bank of england"),
    (4, "new new new york"),
    (5, None),
]


@pytest.mark.parametrize(
    "phrase, wanted",
    [
        ("New York", [(1, 2), (4, 1)]),
        ("new york new", [(1, 1)]),
        ("new new", [(4, 2)]),
        ("bank of england", [(3, 2)]),
        ("england bank", []),
        ("of the", []),
        ("nothing here", []),
    ],
)
def test_phrases(spark, phrase, wanted):
    index = textindex.token_index(spark.createDataFrame(TEXTS, "id int, text string"), "id", ["text"])
    assert rows(textindex.phrase_search(index, "id", phrase)) == wanted


def test_index_is_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "SLICE", 10)
    path = tmp_path / "index"
    first = spark.createDataFrame([(k, f"word{k} common w{k % 3}") for k in range(40)], "id long, text string")
    textindex.write_kept_index(textindex.token_index(first, "id", ["text"]), "id", str(path))

    def files():
        return {f for f in path.rglob("*.parquet")}

    before = files()
    changed = spark.createDataFrame([(3, "other common"), (57, "fresh"), (4, None)], "id long, text string")
    textindex.update_index(spark, str(path), "id", changed, ["text"], gone=first.filter("id BETWEEN 30 AND 39"))
    same = {f for f in before if f.parent.name in ("slice=1", "slice=2")}
    assert before & files() == same and len(same) >= 2
    now = first.filter("id NOT IN (3, 4) AND id < 30").unionByName(changed)
    wanted = textindex.token_index(now, "id", ["text"])
    found = textindex.read_kept_index(spark, str(path))
    assert sorted(map(str, found.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
    # Once more changes nothing.
    textindex.update_index(spark, str(path), "id", changed, ["text"], gone=first.filter("id BETWEEN 30 AND 39"))
    again = textindex.read_kept_index(spark, str(path))
    assert sorted(map(str, again.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
