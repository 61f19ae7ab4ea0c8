"""Landed pages, stored tables and exports."""
