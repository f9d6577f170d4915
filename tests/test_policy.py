import pytest
from arrears.operators import policy, reporting, scenario


@pytest.fixture(scope="module")
def priority(spark):
    """900 customers; a third share the same PD and loan amount."""
    rows = [
        (i, i % 7 == 0 and 1 or 0, 0.5 if i % 3 == 0 else (i % 97) / 100 + 0.00004, None if i % 10 == 1 else 1000.0 if i % 3 == 0 else 100.0 + i, "ab"[i % 2])
        for i in range(900)
    ]
    scored = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, PD double, app_loan_amount double, NAME_CONTRACT_TYPE string")
    return policy.priority_frame(scored, keep=["NAME_CONTRACT_TYPE"])


def test_frame(priority):
    rows = priority.collect()
    assert all(r.PD == round(r.PD, 4) and r.EAD is not None for r in rows)
    assert all(r.expected_loss == pytest.approx(r.PD * r.EAD * 0.45) for r in rows)


def test_loss_order_reaches_most(priority):
    for capacity in (10, 200, 850):
        reached = {r.strategy: r.EL_called for r in policy.evaluate_strategies(priority, capacity).collect()}
        assert max(reached, key=reached.get) == policy.EXPECTED_LOSS


def test_capacity_beyond_the_portfolio(priority):
    rows = policy.evaluate_strategies(priority, 5000).collect()
    assert {r.customers_called for r in rows} == {900}
    assert {r.pct_EL_covered for r in rows} == {100.0}
    assert {r.call_cost for r in rows} == {900 * 150}


def test_positions_follow_each_strategy(priority):
    placed = policy.call_positions(priority.select("SK_ID_CURR", "PD", "expected_loss"), ["expected_loss"])
    rows = placed.collect()
    known = {r.SK_ID_CURR: r for r in priority.collect()}
    keys = {
        policy.HIGHEST_PD: lambda i: (-known[i].PD, i),
        policy.EXPECTED_LOSS: lambda i: (-known[i].expected_loss, i),
    }
    for strategy, key in keys.items():
        own = sorted((r for r in rows if r.strategy == strategy), key=lambda r: r.position)
        assert [r.SK_ID_CURR for r in own] == sorted(known, key=key)
        running = 0.0
        for r in own:
            running += r.expected_loss
            assert r.running_expected_loss == pytest.approx(running)
    assert sorted(r.position for r in rows if r.strategy == policy.RANDOM) == list(range(1, 901))


def test_curve_and_sample_without_an_end(priority):
    whole = policy.recovery_curve(priority, step=50, end=None)
    assert {r.calls for r in whole.collect()} == set(range(50, 900, 50))
    assert {r.calls for r in policy.recovery_curve(priority, step=50, end=300).collect()} == {50, 100, 150, 200, 250}
    assert policy.loss_sample(priority, None).count() == 900
    assert policy.loss_sample(priority, 300).count() == 300


def test_priority_list_is_a_full_ranking(priority):
    rows = policy.priority_list(priority).orderBy("priority_rank").collect()
    assert [r.priority_rank for r in rows] == list(range(1, 901))
    keys = [(-r.expected_loss, r.SK_ID_CURR) for r in rows]
    assert keys == sorted(keys)


def test_ties_at_the_bar_all_count(priority):
    found = reporting.recovery_at_capacity(priority, 1).first()
    best = max(r.expected_loss for r in priority.collect())
    assert found.customers == sum(r.expected_loss == best for r in priority.collect())


def test_grid_matches_the_evaluation(priority):
    cell = scenario.scenario_grid(priority).where("capacity = 200 AND cost_per_call = 150 AND effectiveness = 0.3 AND lgd = 0.45")
    grid = {r.strategy: r.net_profit for r in cell.collect()}
    direct = {r.strategy: r.net_profit for r in policy.evaluate_strategies(priority, 200).collect()}
    assert grid == pytest.approx(direct, abs=0.02)


def test_linear_scenario_at_the_base_is_the_evaluation(priority):
    base = policy.evaluate_strategies(priority, 200)
    linear = {r.strategy: r.recovery for r in scenario.linear_scenario(base).collect()}
    assert linear == pytest.approx({r.strategy: r.recovery_simulated for r in base.collect()}, abs=1.0)


def test_kpis_add_up(priority):
    rows = {r.segment: r for r in reporting.portfolio_kpis(priority, 200).collect()}
    assert rows["All"].customers == rows["a"].customers + rows["b"].customers == 900
    assert rows["All"].capacity_use_pct == 100.0
    assert rows["All"].customers_called == rows["a"].customers_called + rows["b"].customers_called
