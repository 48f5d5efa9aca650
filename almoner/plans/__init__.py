"""Registered queries: every operator on stand-in CRM tables, each with its SQL counterpart."""
