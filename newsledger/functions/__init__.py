"""Pure ``Column -> Column`` builders. Everything here stays inside the JVM
(whole-stage codegen / built-in expressions) except the two explicitly marked
vectorised helpers (Unicode NFKC and the string-similarity ratio)."""
