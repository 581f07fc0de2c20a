"""Declared record schemas. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()

EVENT = _schema(user=_S, url=_S, timestamp=_L)
CLICK_CSV = _schema(user_name=_S, url=_S, ts=_L)
LOGIN = _schema(user_id=_S, ip_address=_S, event_type=_S, timestamp=_L)
ORDER = _schema(user_id=_S, order_id=_S, event_type=_S, timestamp=_L)
ACTION = _schema(user_id=_S, action=_S, seq=_L)
RULE = _schema(action1=_S, action2=_S, rule_seq=_L)
URL_VIEW_COUNT = _schema(url=_S, cnt=_L, window_start=_TS, window_end=_TS)
KEYED = _schema(key=_S, ts=_L)
APP_BILL = _schema(order_id=_S, source=_S, ts=_L)
PLATFORM_BILL = _schema(order_id=_S, source=_S, status=_S, ts=_L)
