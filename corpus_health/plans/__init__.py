"""Plan shapes shared by the operators, and the compositions built from them."""
