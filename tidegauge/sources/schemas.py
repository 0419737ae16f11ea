"""Record types of the delimited inputs. Event times keep the unit of their file."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"long": LongType(), "int": IntegerType(), "string": StringType()}


def _record(**fields: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields.items()])


# ts in epoch seconds
USER_BEHAVIOR = _record(user_id="long", item_id="long", category="int", behavior="string", ts="long")
AD_CLICK = _record(user_id="long", ad_id="long", province="string", city="string", ts="long")
LOGIN = _record(user_id="long", ip="string", state="string", ts="long")
ORDER = _record(order_id="long", oper_type="string", tx_id="string", ts="long")
RECEIPT = _record(tx_id="string", channel="string", ts="long")
FEEDBACK = _record(id="string", ts="long", fre="int")
# ts in epoch milliseconds
MARKET = _record(user_id="string", channel="string", behavior="string", ts="long")
STATION = _record(id="string", event_type="string", ts="long")
