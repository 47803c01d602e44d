"""Keys that share a state row: each is decided, remembered and forgotten as if it were alone."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta
from random import Random

from test_estado import llegar, partes, primeras
from test_streaming import pedido

from lonja.streaming import stateful

HORIZONTE = timedelta(days=5)


def esperadas(lotes):
    """The rule, key by key: (sale, part) counts over batches of (number, day of the month) pairs."""
    vistas, salida, maximo = {}, Counter(), None
    for lote in lotes:
        marca = maximo - HORIZONTE if maximo else datetime(1970, 1, 1)
        for n, dia in lote:
            momento = datetime(2025, 4, dia, 10)
            if momento < marca:
                parte = "tardias"
            else:
                parte = "repetidas" if n in vistas else "a_tiempo"
            if parte != "tardias" or n in vistas:
                vistas[n] = max(vistas.get(n, marca), momento, marca)
            salida[f"o{n}", parte] += 1
            maximo = max(maximo or momento, momento)
        vistas = {n: hasta for n, hasta in vistas.items() if hasta + timedelta(milliseconds=1) >= marca}
    return salida


def test_keys_in_a_shared_state_row_are_told_apart(spark, run_ts, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "CUBETAS", 3)
    azar = Random(5)
    lotes = [[(azar.randrange(12), azar.randint(max(1, 4 * n - 8), 4 * n + 3)) for _ in range(14)] for n in range(6)]
    lotes[0] += [(90 + n, 1) for n in range(20)]
    lotes[-1] += [(90 + n, 23) for n in range(20)]  # forgotten by then: on time once more
    carpeta = tmp_path / "eventos"
    for n, lote in enumerate(lotes):
        llegar(carpeta, n, [pedido(k, 10, dia=dia) for k, dia in lote])
    consulta = primeras(spark, carpeta, run_ts, tmp_path / "s", tmp_path / "c")
    salida = partes(spark, tmp_path / "s")
    assert salida == esperadas(lotes) and {p for _, p in salida} == {"a_tiempo", "repetidas", "tardias"}
    assert salida["o95", "a_tiempo"] == 2
    estados = [p["stateOperators"][0]["numRowsTotal"] for p in consulta.recentProgress if p["numInputRows"]]
    assert max(estados) <= 3  # 32 keys, one state row and one call per group
