"""Write a synthetic incident file set (raw CSV + 3 catalogs) for load timing.

    python tools/make_incident_sample.py OUT_DIR [ROWS]

Rows are random but seeded (32 entities x 39 municipalities, 2024 dates,
classification mix about 82/16/2 %); the output is scratch data, never
committed.
"""

from __future__ import annotations

import csv
import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests"))

import incident_fixture as fx  # noqa: E402
from incidentmart.constants import INCIDENT_FILE  # noqa: E402


def main():
    out = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 390_000
    rnd = random.Random(7)
    os.makedirs(out, exist_ok=True)
    places = [(str(e), str(m)) for e in range(1, 33) for m in range(1, 40)]
    classes = ["Sólo daños", "No fatal", "Fatal"]
    kinds = ["Colisión con vehículo automotor", "Colisión con motocicleta", "Salida del camino",
             "Volcadura", "Atropellamiento"]
    with open(os.path.join(out, INCIDENT_FILE), "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(fx.HEADER)
        for _ in range(n):
            e, m = rnd.choice(places)
            w.writerow(fx.row(ent=e, mun=m, m=str(rnd.randint(1, 12)), d=str(rnd.randint(1, 28)),
                              h=str(rnd.randint(0, 23)), mi=str(rnd.randint(0, 59)),
                              edad=str(rnd.randint(1, 20)),
                              clas=rnd.choices(classes, [82, 16, 2])[0], tip=rnd.choice(kinds),
                              sexo=rnd.choice(["Hombre", "Mujer", "Se fugó"]),
                              veh={"automovil": rnd.randint(0, 2), "motociclet": rnd.randint(0, 1)},
                              per={"neherido": rnd.randint(0, 2),
                                   "nemuerto": int(rnd.random() < 0.01)}))
    fx.write_csv(os.path.join(out, "tc_entidad.csv"), ["id_entidad", "nom_entidad"],
                 [[str(e), f"Entidad {e}"] for e in range(1, 33)])
    fx.write_csv(os.path.join(out, "tc_municipio.csv"), ["id_entidad", "id_municipio", "nom_municipio"],
                 [[e, m, f"Municipio {e}-{m}"] for e, m in places])
    fx.write_csv(os.path.join(out, "tc_edad.csv"), ["id_edad", "desc_edad"],
                 [[str(a), f"Edad {a}"] for a in range(0, 21)])


if __name__ == "__main__":
    main()
