"""Settings of the hourly urban-rail passenger forecast.

Fixed values: they decide which records and features come out.
"""

from __future__ import annotations

from datetime import datetime

from ..operators.clean import TripRules
from ..spec import PanelSpec

PANEL = PanelSpec(target="passage", time="timestamp", keys=("line_name", "station"), step="1h")

INTERVALS = ("1 day", "1 week", "1 month", "3 months")
HORIZON_DAYS = 30
LAGS = (30, 31, 32, 33, 35, 37, 40, 42, 49, 56, 63, 70)

TRAIN_SINCE = datetime(2023, 1, 1)
LAST_TEST_HOUR = datetime(2024, 6, 30, 23)
FOLD_COUNT = 4
FOLD_DAYS = 30

RAIL_TRIPS = TripRules(
    mode="RAYLI",
    lines=("M1", "M2", "M4", "T1", "MARMARAY"),
    removed=(
        " (GUNEY)",
        " (KUZEY)",
        " (BATI)",
        " (DOGU)",
        " GUNEY",
        " KUZEY",
        " BATI",
        " DOGU",
    ),
    names={
        "HASTANE (DOGU/ADLIYE)": "HASTANE",
        "SABIHA GOKCEN HAVALIMANI": "SABIHA GOKCEN",
        "M4 KURTKOY": "KURTKOY",
        "SEYRANTEPE 3 STAD GIRISI": "SEYRANTEPE",
        "SEYRANTEPE 1": "SEYRANTEPE",
        "SEYRANTEPE 2": "SEYRANTEPE",
        "4 LEVENT 2": "4 LEVENT",
        "LEVENT 2": "LEVENT",
        "SISLI 2": "SISLI",
        "OSMANBEY 2": "OSMANBEY",
        "OTOGAR 1": "OTOGAR",
        "AKSARAY 1": "AKSARAY",
        "SIRKECI-4": "SIRKECI",
        "SIRKECI-3": "SIRKECI",
        "SIRKECI-2": "SIRKECI",
        "SIRKECI-1": "SIRKECI",
        "BAKIRKOY-1": "BAKIRKOY",
        "BAKIRKOY-2": "BAKIRKOY",
        "USKUDAR-1": "USKUDAR",
        "USKUDAR-2": "USKUDAR",
        "USKUDAR-3": "USKUDAR",
        "GEBZE-1": "GEBZE",
        "GEBZE-2": "GEBZE",
        "KUCUKYALI-1": "KUCUKYALI",
        "KUCUKYALI-2": "KUCUKYALI",
        "YENIKAPI-1": "YENIKAPI",
        "YENIKAPI-2": "YENIKAPI",
        "YENIKAPI-3": "YENIKAPI",
        "TERSANE-1": "TERSANE",
        "TERSANE-2": "TERSANE",
        "BOSTANCI-1": "BOSTANCI",
        "BOSTANCI-2": "BOSTANCI",
        "CEVIZLI-1": "CEVIZLI",
        "CEVIZLI-2": "CEVIZLI",
        "EMINONU 2": "EMINONU",
        "ZEYTINBURNU 2": "ZEYTINBURNU",
        "KABATAS 2": "KABATAS",
        "AYRILIKCESME": "AYRILIKCESMESI",
        "CAMI": "YAVUZSELIM",
        "KERESTECILER": "MERTER",
    },
)
