from .columns import (GRAINS, MONEY, MONEY_SUM, RATE, TAX_SUM, as_date, day_of_week_sunday0, discount_amount,
                      flag_int, mean, money, net_revenue, open_end_ts, pct, rate, ratio, surrogate_key, time_grain)

__all__ = ["GRAINS", "MONEY", "MONEY_SUM", "RATE", "TAX_SUM", "as_date", "day_of_week_sunday0", "discount_amount",
           "flag_int", "mean", "money", "net_revenue", "open_end_ts", "pct", "rate", "ratio", "surrogate_key",
           "time_grain"]
