from larder.operators.aggregates import class_share
from larder.operators.joins import match_rate
from larder.operators.quality import rule_funnel, schema_problems
from larder.plans import serving, silver
from larder.schemas import MART_SCHEMAS, PRODUCT_RENAMES


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def test_ingest_counts_what_is_on_disk(golden):
    assert golden.product_metrics["rows_read"] == golden.product_metrics["rows_written"] == 13
    assert golden.product_metrics["output_path"].endswith("/year=2024/month=5/day=14")
    assert golden.country_metrics["rows_written"] == 5


def test_conformed_types_and_lenient_values(golden):
    types = dict(golden.bronze.dtypes)
    assert types["additives_n"] == "int" and types["fat_100g"] == "double"
    assert "brands" not in types and types["categories_en"] == "string"
    by_name = {r.product_name: r for r in golden.bronze.collect()}
    assert by_name["Choco bar (old)"].additives_n == 3
    assert by_name["Bad num"].fat_100g is None
    assert by_name["Bad num"]["nutrition-score-fr_100g"] is None


def test_funnel(golden):
    funnel = rule_funnel(golden.bronze, silver.product_rules(), ["code"])
    assert rows(funnel, "rule", "removed", "remaining") == [
        ("product_name", 1, 12),
        ("nutrition_grade", 2, 10),
        ("nutrition_ranges", 2, 8),
        ("duplicate_key", 1, 7),
    ]
    assert rows(funnel, "rejected_pct")[-1] == (46.1538,)


def test_kept_products(golden):
    kept = {r.code: r for r in golden.products.collect()}
    assert sorted(kept) == ["001", "002", "003", "009", "010", "011", "012"]
    assert kept["001"].product_name == "Choco bar" and kept["001"].nutrition_grade_fr == "E"
    assert kept["001"].main_category == "snacks" and kept["010"].countries_en == "spain,spain"
    assert not set(PRODUCT_RENAMES) & set(golden.products.columns)


def test_countries(golden):
    found = {r.country_normalized: (r.country, r.population, r.pop_density) for r in golden.countries.collect()}
    assert found == {
        "france": ("France", 60876136, 111.3),
        "germany": ("Germany", 82422299, 230.9),
        "japan": ("Japan", 127463611, None),
        "spain": ("Spain", 40397842, 80.0),
    }


def test_join(golden):
    pairs = sorted(rows(golden.enriched, "code", "country_single", "country_normalized"), key=str)
    assert pairs == sorted(
        [
            ("001", "france", "france"), ("001", "spain", "spain"), ("002", "france", "france"),
            ("002", "atlantis", None), ("003", "spain", "spain"), ("009", None, None),
            ("010", "spain", "spain"), ("010", "spain", "spain"), ("011", "germany", "germany"),
            ("012", "france", "france"),
        ],
        key=str,
    )
    assert rows(match_rate(golden.enriched, "country_normalized")) == [(10, 8, 2, 80.0)]


def test_category_means(golden):
    found = {r[0]: r[1:] for r in rows(silver.category_profile(golden.enriched),
             "main_category", "avg_sugars_100g", "avg_fat_100g", "avg_salt_100g", "avg_energy_kj_100g", "product_count")}
    assert found["snacks"][0] == 45.8 and found["snacks"][1] == 25.0
    assert abs(found["snacks"][2] - 0.46) < 1e-12 and found["snacks"][3:] == (1860.0, 5)
    assert found["beverages"] == (10.6, 0.0, 0.02, 180.0, 3)
    assert found["legumes"] == (2.0, 1.0, 0.01, 1400.0, 1)
    assert len(found) == 3


def test_sugar_rank_keeps_the_null_category(golden):
    ranked = silver.with_sugar_rank(golden.enriched)
    assert ranked.count() == 10
    places = rows(ranked.where("main_category = 'snacks'").orderBy("sugar_rank_in_category"),
                  "code", "country_single", "sugar_rank_in_category")
    assert places == [("001", "france", 1), ("001", "spain", 2), ("010", "spain", 3),
                      ("010", "spain", 4), ("012", "france", 5)]
    assert rows(ranked.where("main_category is null"), "code", "sugar_rank_in_category") == [("011", 1)]
    assert silver.with_sugar_rank(golden.enriched, skip_null_groups=True).count() == 9


def test_sugar_mart(golden):
    assert rows(golden.sugar.orderBy("category", "sugar_rank_in_category")) == [
        ("beverages", "Cola", 10.6, "E", 1),
        ("beverages", "Water", None, "B", 2),
        ("legumes", "Lentils", 2.0, "A", 1),
        ("snacks", "Choco bar", 55.5, "E", 1),
        ("snacks", "Biscuit", 55.5, "D", 2),
    ]


def test_grade_mart(golden):
    assert rows(golden.grade.orderBy("country", "nutrition_grade_fr")) == [
        ("France", "WESTERN EUROPE", "C", 1, None),
        ("France", "WESTERN EUROPE", "E", 2, 19.0),
        ("Germany", "WESTERN EUROPE", "C", 1, 6.0),
        ("Spain", "WESTERN EUROPE", "A", 1, -4.0),
        ("Spain", "WESTERN EUROPE", "D", 2, 14.0),
        ("Spain", "WESTERN EUROPE", "E", 1, 20.0),
    ]


def test_additive_mart(golden):
    assert rows(golden.additive.orderBy("rank_overall")) == [
        ("en:e322", 4, 1, 1, 40.0),
        ("en:e330", 3, 1, 2, 30.0),
        ("en:e338", 2, 1, 3, 20.0),
        ("en:e476", 2, 1, 4, 20.0),
    ]


def test_feature_mart(golden):
    found = {r.code: r for r in golden.feature.collect()}
    assert {c: r.country_normalized for c, r in found.items()} == {
        "001": "france", "002": "france", "003": "spain", "009": None, "010": "spain",
        "011": "germany", "012": "france",
    }
    assert [found[c].additives_n for c in sorted(found)] == [2, 1, 0, 0, 1, 1, 1]
    assert found["012"].fat_100g is None and found["003"].population == 40397842


def test_feature_means(golden):
    found = {r[0]: r[1:] for r in rows(serving.feature_means(golden.feature),
             "grade", "count", "avg_energy", "avg_fat", "avg_sugars", "avg_additives")}
    assert found == {
        "A": (1, 1400.0, 1.0, 2.0, 0.0), "B": (1, None, None, None, 0.0),
        "C": (2, 900.0, 5.0, 9.5, 1.0), "D": (1, 2000.0, 20.0, 55.5, 1.0),
        "E": (2, 1190.0, 15.0, 33.05, 1.5),
    }


def test_grade_summary(golden):
    assert rows(serving.grade_summary(golden.grade)) == [
        ("A", 1, -4.0), ("C", 2, 6.0), ("D", 1, 14.0), ("E", 2, 19.5),
    ]


def test_class_share_adds_up(golden):
    shares = class_share(golden.feature, "nutrition_grade_fr")
    assert abs(sum(r.pct for r in shares.collect()) - 100) < 1e-9


def test_marts_keep_their_contract(golden):
    for name, mart in [("dm_sugar_by_category", golden.sugar), ("dm_nutriscore_by_country", golden.grade),
                       ("dm_additives_analysis", golden.additive), ("dm_ml_nutriscore_prediction", golden.feature)]:
        assert schema_problems(mart, MART_SCHEMAS[name]) == []
    assert schema_problems(golden.sugar.drop("category"), MART_SCHEMAS["dm_sugar_by_category"])


def test_serving_filters(golden):
    sugar = golden.sugar
    assert serving.sugar_page(sugar, category="").total.first()[0] == 5
    assert serving.sugar_page(sugar, min_sugars=0).total.first()[0] == 4
    assert rows(serving.sugar_page(sugar, grade="e").items, "product_name") == [("Cola",), ("Choco bar",)]
    page = serving.grade_page(golden.grade, page=2, limit=4)
    assert page.total.first()[0] == 6
    assert rows(page.items, "avg_nutriscore_score") == [(20.0,), (None,)]
    assert serving.grade_page(golden.grade, country="fRANCE", region="western europe").total.first()[0] == 2
    assert rows(serving.sugar_categories(sugar)) == [("beverages",), ("legumes",), ("snacks",)]
    assert rows(serving.top_additives(golden.additive, 1), "additive_tag") == [("en:e322",)]
    first, again = (serving.feature_sample(golden.feature, 3, seed=5).collect() for _ in range(2))
    assert first == again and len(first) == 3
