import pytest

from kontora.plans import semantic as sem


@pytest.mark.parametrize("view", list(sem.VIEWS.values()), ids=lambda v: v.name)
def test_every_metric_works_with_every_reachable_dimension(bank, view):
    for m in view.metrics:
        dims = view.reachable(m)
        assert dims
        df = sem.semantic_query(bank, view, [m], dims)
        assert df.columns == [*dims, m.replace(".", "_")]


def test_sizes():
    assert sum(len(v.metrics) for v in sem.VIEWS.values()) == 52
    assert sum(len(v.dimensions) for v in sem.VIEWS.values()) == 46


def test_shortest_path_and_errors(bank):
    v = sem.CUSTOMER_BANKING
    assert v.path("cards", "customers") == [("cards", "customer_id", "customers")]
    assert v.path("customers", "cards") is None
    with pytest.raises(ValueError):
        sem.semantic_query(bank, v, ["total_customers"], ["card_type"])
    with pytest.raises(KeyError):
        v.metric("total_deposits")  # two tables have one
    with pytest.raises(KeyError):
        sem.semantic_query(bank, v, ["total_customers"], ["nope"])


def test_dimension_over_two_links(bank):
    v = sem.SemanticView(
        "t", {"cards": "card_id", "accounts": "account_id", "customers": "customer_id"},
        [("cards", "account_id", "accounts"), ("accounts", "customer_id", "customers")], {"risk_tier": "customers"}, {"cards.n": "COUNT(card_id)"},
    )
    got = {r.risk_tier: r.n for r in sem.semantic_query(bank, v, ["n"], ["risk_tier"]).collect()}
    assert sum(got.values()) == bank.cards.count() and len(got) == 3


def test_no_dimensions_gives_one_row(bank):
    rows = sem.semantic_query(bank, sem.CUSTOMER_BANKING, ["total_customers", "total_accounts"]).collect()
    assert len(rows) == 1 and rows[0].total_accounts == 2 * rows[0].total_customers
