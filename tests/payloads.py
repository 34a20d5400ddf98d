"""Builders of sensor files."""

import gzip
import json
from datetime import datetime, timedelta
from pathlib import Path

FULL = {
    "datetime": "31.08.2023 21:44",
    "plugs": {"Office": {"power": 12.5, "total": 1500, "temperature": 21.0}},
    "doorsWindows": {
        "Bdroom": [{"type": "Door", "switch": "on", "battery": 90}, {"type": "Window", "switch": "off"}],
        "Kitchen": {"type": "Window", "switch": "ON"},
    },
    "motions": {"Bhroom": {"motion": True, "light": 3, "temperature": 22.4}},
    "meteos": {
        "meteo": {
            "Livingroom": {
                "Temperature": 99,
                "CO2": 410,
                "Humidity": 45,
                "Noise": 38,
                "Pressure": 1012,
                "AbsolutePressure": 955,
                "battery_percent": 80,
            }
        }
    },
    "humidities": {"Laundry": {"temperature": 20.1, "humidity": 61, "devicePower": 77}},
    "consumptions": {
        "House": {
            "total_power": 850,
            "power1": 300,
            "power2": 250,
            "power3": 300,
            "current1": 1.3,
            "current2": 1.1,
            "current3": 1.3,
            "voltage1": 231,
            "voltage2": 230,
            "voltage3": 232,
        }
    },
}


def file_name(at: datetime, apartment: str) -> str:
    return f"{at:%d.%m.%Y %H%M}_{apartment}_received.json"


def write(root: Path, name: str, payload, compress: bool = False) -> Path:
    root.mkdir(parents=True, exist_ok=True)
    text = payload if isinstance(payload, str) else json.dumps(payload)
    path = root / (name + ".gz" if compress else name)
    if compress:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        path.write_text(text, encoding="utf-8")
    return path


def plug(power, total=None, room="Office", at="31.08.2023 21:44"):
    return {"datetime": at, "plugs": {room: {"power": power, "total": total}}}


def minutes(start: datetime, n: int):
    return [start + timedelta(minutes=i) for i in range(n)]
