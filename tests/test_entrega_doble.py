"""A feed that is delivered twice is worked out once."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from lonja import feeds
from lonja.contracts import VENTAS_TIENDAS
from lonja.operators.conform import devueltas, validas
from lonja.plans.queries import CONSULTAS


def test_the_second_delivery_is_the_first_one_again(spark, sf_dir, monkeypatch):
    feed = feeds.ventas_tiendas
    vueltas, buenas = (clase(feed(spark, sf_dir), VENTAS_TIENDAS).count() for clase in (devueltas, validas))
    # ids drawn anew whenever the feed is worked out
    nuevo = F.udf(lambda: uuid4().hex).asNondeterministic()
    monkeypatch.setattr(feeds, "ventas_tiendas", lambda *a: feed(*a).withColumn("id_transaccion", nuevo()))
    assert tuple(CONSULTAS["devoluciones_repetidas"](spark, sf_dir).first()) == (vueltas, vueltas, buenas)
