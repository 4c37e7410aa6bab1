"""Column functions: scoring, calendar and text. All run inside codegen."""
