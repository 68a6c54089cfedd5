"""Schemas of the tables that operators share."""

from __future__ import annotations

MEASUREMENTS = "station_code string, station_type string, origin string, type_name string, period int, ts timestamp, value double, string_value string, json_value string, created_on timestamp"
STATIONS = "station_code string, station_type string, name string, origin string, active boolean, available boolean, x double, y double, srid int, parent_code string, metadata string"
EDGES = "link_code string, link_type string, origin_code string, destination_code string, length_m double, geometry array<struct<x: double, y: double>>"
KEY = ["station_code", "type_name", "period"]
