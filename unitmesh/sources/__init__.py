"""Readers: directive CSV, csv/json tables, service response shapes."""
