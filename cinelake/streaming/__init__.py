"""No streaming operators: every source this library covers is a finite table."""
