"""Operators on tables and bundles: columns, validation, copies, access control, audits."""
