"""Small incident CSV fixtures in the published raw layout (our own rows)."""

from __future__ import annotations

import csv
import os

from incidentmart.constants import INCIDENT_FILE, PERSON_COLUMNS, VEHICLE_COLUMNS

HEADER = (["id_entidad", "id_municipio", "anio", "mes", "id_dia", "id_hora", "id_minuto",
           "id_edad", "cobertura", "tipaccid", "causaacci", "clasacc", "urbana", "suburbana",
           "caparod", "estatus", "sexo", "aliento", "cinturon"]
          + list(VEHICLE_COLUMNS) + list(PERSON_COLUMNS))


def row(ent="19", mun="39", y="2024", m="3", d="15", h="8", mi="30", edad="5",
        cob="Municipal", tip="Colisión con vehículo automotor", cau="Conductor",
        clas="Sólo daños", urb="Intersección", sub="Sin accidente en esta zona",
        cap="Pavimentada", est="Cifras definitivas", sexo="Hombre", ali="No", cin="Sí",
        veh=None, per=None):
    veh = veh or {}
    per = per or {}
    out = [ent, mun, y, m, d, h, mi, edad, cob, tip, cau, clas, urb, sub, cap, est, sexo, ali, cin]
    out += [str(veh.get(c, "1" if c == "automovil" else "0")) for c in VEHICLE_COLUMNS]
    out += [str(per.get(c, "0")) for c in PERSON_COLUMNS]
    return out


def default_rows():
    rows = []
    # A spread of ordinary incidents over two entities, several municipalities.
    for i in range(40):
        ent, mun = ("19", str(39 + i % 3)) if i % 2 == 0 else ("8", str(19 + i % 2))
        rows.append(row(ent=ent, mun=mun, m=str(1 + i % 12), d=str(1 + i % 28),
                        h=str(i % 24), mi=str((i * 7) % 60),
                        clas=["Sólo daños", "No fatal", "Fatal"][i % 3],
                        veh={"automovil": 1 + i % 2, "motociclet": int(i % 3 == 0)},
                        per={"nemuerto": 1 if i % 3 == 2 else 0,
                             "neherido": 2 if i % 3 == 1 else 0,
                             "condmuerto": 1 if i % 3 == 2 else 0}))
    # Golden cases.
    rows.append(row(h="", mi="15"))                       # missing hour -> time_key 15
    rows.append(row(h="99", mi="10"))                     # unknown hour -> -1
    rows.append(row(h="5", mi="99"))                      # unknown minute -> -1
    rows.append(row(y="2024", m="2", d="29"))             # leap day
    rows.append(row(mun="999"))                           # municipality not in catalog
    rows.append(row(edad=""))                             # null age id -> catalog null row
    rows.append(row(cob="  NA", sexo=" Mujer ", ali="\t", cin="NA"))  # text cleaning
    rows.append(row(veh={"automovil": "3.7", "camion": "x", "bicicleta": ""}))  # numbers
    return rows


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def write_bundle(directory, rows=None, header=None, entidad=None, municipio=None, edad=None):
    os.makedirs(directory, exist_ok=True)
    header = header or [f" {h.upper()} " if h == "id_entidad" else h for h in HEADER]
    write_csv(os.path.join(directory, INCIDENT_FILE), header,
              rows if rows is not None else default_rows())
    write_csv(os.path.join(directory, "tc_entidad.csv"), ["ID_ENTIDAD", "NOM_ENTIDAD"],
              entidad or [["19", "Nuevo León"], ["8", "Chihuahua"]])
    write_csv(os.path.join(directory, "tc_municipio.csv"),
              ["id_entidad", "id_municipio", "nom_municipio"],
              municipio or [["19", "39", "Monterrey"], ["19", "40", "Guadalupe"],
                            ["19", "41", "Apodaca"], ["8", "19", "Chihuahua"],
                            ["8", "20", "Juárez"]])
    write_csv(os.path.join(directory, "tc_edad.csv"), ["id_edad", "desc_edad"],
              edad or [["5", "25 a 29 años"], ["", "No especificada"]])
    return directory
