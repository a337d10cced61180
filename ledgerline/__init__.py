"""Public-record triage and ranking as parameterised Spark DataFrame operators."""
