import pytest

from rebuy.plans.features import FEATURES, feature_table, prior_aggregates
from tests.toy import A, B, C

EXPECTED = {
    # (user, product): column -> value
    (1, A): dict(reordered=1, user_product_reordered_past=2, user_product_ordered_last_n_order=0,
                 user_product_ave_add_to_cart_order_scale=0.666667,
                 user_product_ave_days_since_prior_order=3.5,
                 user_product_percent_order_containing_product=1.0,
                 user_product_ave_day_per_product_order=2.333333,
                 current_order_days_since_last_product_purchase=4.0,
                 current_order_since_last_product_purchase_vs_average_purchase_gap=1.714286,
                 current_order_gap_deviation=-4.949747, current_same_day_order=1),
    (1, B): dict(reordered=0, user_product_reordered_past=1, user_product_ordered_last_n_order=0,
                 user_product_ave_add_to_cart_order_scale=0.75,
                 user_product_ave_days_since_prior_order=4.0,
                 user_product_percent_order_containing_product=0.666667,
                 user_product_ave_day_per_product_order=3.5,
                 current_order_days_since_last_product_purchase=4.0,
                 current_order_since_last_product_purchase_vs_average_purchase_gap=1.142857,
                 current_order_gap_deviation=-4.949747, current_same_day_order=1),
    (1, C): dict(reordered=0, user_product_reordered_past=0, user_product_ordered_last_n_order=1,
                 user_product_ave_add_to_cart_order_scale=1.0,
                 user_product_ave_days_since_prior_order=3.0,
                 user_product_percent_order_containing_product=0.333333,
                 user_product_ave_day_per_product_order=7.0,
                 current_order_days_since_last_product_purchase=7.0,
                 current_order_since_last_product_purchase_vs_average_purchase_gap=1.0,
                 current_order_gap_deviation=-4.949747, current_same_day_order=0),
    (2, B): dict(reordered=0, user_product_reordered_past=0, user_product_ordered_last_n_order=0,
                 user_product_ave_add_to_cart_order_scale=1.0,
                 user_product_ave_days_since_prior_order=7.0,
                 user_product_percent_order_containing_product=1.0,
                 user_product_ave_day_per_product_order=0.0,
                 current_order_days_since_last_product_purchase=12.0,
                 current_order_since_last_product_purchase_vs_average_purchase_gap=24.0,
                 current_order_gap_deviation=99999.0, current_same_day_order=0),
}


def test_feature_values(toy):
    df, _ = feature_table(toy.orders, toy.prior, toy.train, toy.products)
    assert df.columns[:3] == ["user_id", "product_id", "reordered"]
    assert df.columns[3:] == FEATURES
    rows = {(r.user_id, r.product_id): r.asDict() for r in df.collect()}
    assert set(rows) == set(EXPECTED)          # D is never a candidate
    for key, exp in EXPECTED.items():
        for col, v in exp.items():
            assert rows[key][col] == pytest.approx(v, abs=1e-6), (key, col)


def test_user_and_product_features(toy):
    prior = prior_aggregates(toy.orders, toy.prior)
    u = {r.user_id: r for r in prior.users.collect()}
    assert (u[1].user_total_order, u[1].user_cart_size, u[1].user_total_product) == (3, 2.0, 6)
    assert u[1].user_days_since_last_order_mean == pytest.approx(3.5)
    assert u[1].user_days_since_last_order_std == pytest.approx(0.707107, abs=1e-6)
    assert (u[1].user_total_uniq_product, u[1].user_uniq_prod_over_total_prod) == (3, 0.5)
    assert (u[2].user_total_order, u[2].user_cart_size, u[2].user_total_product) == (1, 1.0, 1)
    assert u[2].user_days_since_last_order_mean is None
    assert u[2].user_days_since_last_order_std is None
    p = {r.product_id: r for r in prior.products.collect()}
    assert (p[A].product_total_orders, p[A].product_avg_add_to_cart_order) == (3, pytest.approx(4 / 3))
    assert p[A].product_percent_order_containing_product == 0.75
    assert (p[C].product_total_orders, p[C].product_avg_add_to_cart_order,
            p[C].product_percent_order_containing_product) == (1, 2.0, 0.25)


def test_cumulative_days_first_order(toy):
    prior = prior_aggregates(toy.orders, toy.prior)
    cd = {(r.user_id, r.order_number): r.user_product_days_before_last_product_order
          for r in prior.order_table.collect()}
    assert cd == {(1, 3): 4.0, (1, 2): 7.0, (1, 1): 14.0, (2, 1): 7.0}
