"""A small demand panel: two dishes in three stores, with gaps, promotions that vary and a missing cuisine."""

COLUMNS = (
    "id bigint, week int, center_id bigint, meal_id int, center_type string, category string, cuisine string, "
    "checkout_price double, base_price double, discount_ratio double, price_ratio double, emailer_for_promotion int, "
    "homepage_featured int, both_promos int, any_promo int, promo_discount_synergy double, num_orders double"
)
STORES = {3: "CITY", 8: "ROAD", 21: "CITY"}
DISHES = {7: ("Soup", "Thai"), 9: ("Salad", None)}
FULL_PRICE = 95.0


def store_rows(weeks):
    """Rows as tuples. A pair misses every ninth week, but no week is without rows."""
    out = []
    pairs = [(s, d) for s in STORES for d in DISHES]
    for week, (store, dish) in ((w, p) for w in range(1, weeks + 1) for p in pairs):
        if (week * 5 + store + dish) % 9 == 0:
            continue
        price = 80.0 + week * store % 13
        mail, home = int(week % 4 == 0 and dish == 7), int(week % 6 == store % 6)
        cut = (FULL_PRICE - price) / FULL_PRICE
        orders = 40.0 + 6 * store + 3 * dish - 0.2 * (price - 80) + 12 * mail + 8 * home + week * week % 5
        flags = (mail, home, mail & home, mail | home, (mail | home) * cut)
        out.append(
            (1000 + len(out), week, store, dish, STORES[store], *DISHES[dish], price, FULL_PRICE, cut, price / FULL_PRICE, *flags, orders)
        )
    return out


def store_panel(spark, weeks=31):
    return spark.createDataFrame(store_rows(weeks), COLUMNS)
