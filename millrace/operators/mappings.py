"""Tracker field names and what they become."""

from __future__ import annotations

from millrace.functions import net, text

CASTS = {
    "string": text.to_string,
    "int": text.to_int,
    "float": text.to_float,
    "tstamp": text.to_tstamp,
    "boolean": text.to_boolean,
    "ip": net.first_ip,
}
FALLIBLE = ("int", "float", "tstamp")

# Tracker parameter -> (cast, field), applied to every event.
BASE_FIELDS = {
    "eid": ("string", "event_id"),
    "aid": ("string", "app_id"),
    "p": ("string", "platform"),
    "dtm": ("tstamp", "dvce_created_tstamp"),
    "ttm": ("tstamp", "true_tstamp"),
    "stm": ("tstamp", "dvce_sent_tstamp"),
    "tv": ("string", "v_tracker"),
    "cv": ("string", "v_collector"),
    "tna": ("string", "name_tracker"),
    "ip": ("ip", "user_ipaddress"),
    "uid": ("string", "user_id"),
    "duid": ("string", "domain_userid"),
    "vid": ("int", "domain_sessionidx"),
    "sid": ("string", "domain_sessionid"),
    "nuid": ("string", "network_userid"),
    "ua": ("string", "useragent"),
    "lang": ("string", "language"),
}

# The same, applied by event name. A later row for the same field wins.
EVENT_FIELDS = {
    "page_view": {
        "refr": ("string", "page_referrer"),
        "url": ("string", "page_url"),
        "page": ("string", "page_title"),
    },
    "page_ping": {
        "pp_mix": ("int", "pp_xoffset_min"),
        "pp_max": ("int", "pp_xoffset_max"),
        "pp_miy": ("int", "pp_yoffset_min"),
        "pp_may": ("int", "pp_yoffset_max"),
    },
    "structured_event": {
        "se_ca": ("string", "category"),
        "se_ac": ("string", "action"),
        "se_la": ("string", "label"),
        "se_pr": ("string", "property"),
        "se_va": ("string", "value"),
    },
    "transaction": {
        "tid": ("string", "txn_id"),
        "tr_id": ("string", "tr_orderid"),
        "tr_af": ("string", "tr_affiliation"),
        "tr_tt": ("float", "tr_total"),
        "tr_tx": ("float", "tr_tax"),
        "tr_sh": ("float", "tr_shipping"),
        "tr_ci": ("string", "tr_city"),
        "tr_st": ("string", "tr_state"),
        "tr_co": ("string", "tr_country"),
        "tr_cu": ("string", "tr_currency"),
    },
    "transaction_item": {
        "ti_id": ("string", "ti_orderid"),
        "ti_sk": ("string", "ti_sku"),
        "ti_na": ("string", "ti_name"),
        "ti_nm": ("string", "ti_name"),
        "ti_ca": ("string", "ti_category"),
        "ti_pr": ("float", "ti_price"),
        "ti_qu": ("int", "ti_quantity"),
        "ti_cu": ("string", "ti_currency"),
    },
}

# URL parameters of a campaign and the click ids of ad networks, in order of preference.
CAMPAIGN_PARAMS = {
    "utm_campaign": "campaign",
    "utm_source": "source",
    "utm_medium": "medium",
    "utm_term": "term",
    "utm_content": "content",
}
CLICK_IDS = {
    "gclid": "google",
    "msclkid": "bing",
    "fbclid": "facebook",
    "dclid": "doubleclick",
}


def cast(kind: str, x: str) -> str:
    return CASTS[kind](x)


def bad_cast(kind: str, x: str) -> str:
    """Whether a present value cannot be cast."""
    return f"({x} IS NOT NULL AND ({cast(kind, x)}) IS NULL)" if kind in FALLIBLE else "false"
