"""Shared constants and row builders of the tests."""
import datetime as dt

SF = "/root/testdata/sf0.001"

ORDER_SCHEMA = ("member_id long, order_code string, order_ts timestamp_ntz, status string, "
                "sales_amount double, ts_count long, qty int, total_price double, "
                "total_discount double, total_coupon_discount double, channel string, "
                "payment string, shipping string")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def order(member, code, when, status="Finish", amount=100.0, **kw):
    return (member, code, ts(when) if isinstance(when, str) else when, status, amount,
            kw.get("ts_count", 1), kw.get("qty", 1), kw.get("total_price", amount),
            kw.get("total_discount", 0.0), kw.get("total_coupon_discount", 0.0),
            kw.get("channel", "App"), kw.get("payment", "card"), kw.get("shipping", "home"))
