"""Readers for events and history, the table sink and the shared folder."""
