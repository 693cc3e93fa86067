"""The analytics as DataFrame functions: cleaning, facts, RFM, marts,
delivery and satisfaction analyses, customer marts, quality checks, ML,
insight rules and serving queries."""
