"""Reading, deriving, synthesising and storing tables."""
