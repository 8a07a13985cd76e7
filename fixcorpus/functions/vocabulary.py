"""The threat vocabulary, the standards, the sensitive code areas, and the enums.

Everything here is data that results must agree on; no logic.
"""

from __future__ import annotations

KEY_MATERIAL = [
    "private key leak", "key leak", "seed phrase", "mnemonic", "recovery phrase", "entropy", "weak random", "insecure random", "predictable nonce",
    "Math.random", "rng", "csprng", "key derivation", "bip32", "bip39", "bip44", "slip-0010", "slip39", "hardened derivation", "xprv", "extended private key",
    "keystore", "keychain", "keyring", "secure enclave", "secure element", "encrypted vault", "vault decrypt", "password derivation", "pbkdf2", "scrypt", "argon2",
    "key in logs", "log the key", "plaintext key", "key exposure", "wipe memory", "zeroize", "memory not cleared", "key material",
    "seed", "seedphrase", "privkey", "private key", "secret key", "master key", "wipe", "scrub", "clear from memory",
]
SIGNING = [
    "signature verification", "signature malleability", "invalid signature", "nonce reuse", "k reuse", "deterministic nonce", "rfc6979",
    "eip-712", "eip712", "typed data", "domain separator", "chainId", "eip-155", "replay attack", "cross-chain replay", "signature replay",
    "personal_sign", "eth_sign", "blind sign", "blind signing", "unsigned transaction", "sighash", "psbt", "sigverify", "ecdsa", "schnorr",
    "ed25519", "secp256k1", "low-s", "der encoding", "recovery id", "recid", "message prefix", "signTypedData",
]
APPROVAL = [
    "unlimited approval", "infinite approval", "approve", "allowance", "permit2", "erc-2612", "setApprovalForAll", "revoke approval",
    "spending cap", "delegatecall", "session key", "delegation", "increaseAllowance", "drainer", "wallet drainer",
]
TRANSPORT = [
    "origin check", "origin validation", "postMessage", "cross-origin", "same-origin", "walletconnect", "wc uri", "pairing", "session hijack",
    "session topic", "relay", "deeplink", "deep link", "universal link", "custom scheme", "intent filter", "webview", "javascript interface",
    "rpc method", "unauthorized rpc", "permission bypass", "dapp permission", "content script", "injected provider", "provider spoof",
]
UI_DECEPTION = [
    "address display", "address truncation", "homoglyph", "unicode spoof", "rtl override", "clipboard", "clipboard hijack", "paste address",
    "phishing", "spoofed domain", "punycode", "transaction preview", "decode transaction", "simulation", "misleading", "wrong amount",
    "wrong recipient", "token spoof", "fake token", "scam token",
]
PLATFORM = [
    "xss", "cross-site scripting", "prototype pollution", "unsafe-eval", "csp bypass", "content security policy", "path traversal", "zip slip",
    "insecure deserialization", "sandbox escape", "screen recording", "screenshot", "backup exclusion", "allowBackup", "exported activity",
    "root detection", "jailbreak", "tapjacking", "overlay attack", "autofill", "biometric bypass", "lock screen bypass", "auto-lock",
    "sensitive data in backup", "world-readable", "passkey", "webauthn", "authenticator", "attestation", "clientDataJSON",
    "authenticatorData", "user presence", "user verification", "up flag", "uv flag", "challenge", "rpId", "relying party", "origin binding",
    "credential id", "secp256r1", "p-256", "touchid", "faceid", "platform authenticator", "resident key", "discoverable credential",
]
CONTRACT = [
    "reentrancy", "unchecked call", "storage collision", "uninitialized proxy", "upgrade authorization", "initializer", "selfdestruct", "module bypass",
    "guard bypass", "owner bypass", "threshold bypass", "erc-1271", "isValidSignature", "erc-4337", "userop", "validateUserOp", "paymaster",
    "entrypoint", "bundler", "griefing", "invariant", "audit finding",
]
MPC = [
    "threshold signature", "tss", "mpc", "secret share", "share leakage", "zero-knowledge proof", "range proof", "paillier", "commitment",
    "abort attack", "rogue key", "key resharing", "dkg", "biased nonce", "lattice attack", "small subgroup",
    "shamir", "secret sharing", "share reconstruction", "quorum", "recovery factor", "device share", "social recovery", "guardian",
    "oauth", "social login", "email otp", "magic link", "session token", "share refresh", "threshold bypass",
]
MEMORY = [
    "buffer overflow", "stack overflow", "heap overflow", "out-of-bounds", "out of bounds", "oob", "use-after-free", "uaf", "double free",
    "integer overflow", "integer underflow", "off-by-one", "memcpy", "null pointer", "uninitialized", "segfault", "memory corruption",
    "unsound", "unsafe", "fault injection", "glitch attack", "side channel", "timing attack", "power analysis", "constant time",
]
SUPPLY_CHAIN = [
    "supply chain", "malicious dependency", "compromised package", "typosquat", "postinstall", "update channel", "signature of the update",
    "code signing", "reproducible build", "firmware verification", "bootloader", "secure boot", "rollback attack", "downgrade attack",
]
GENERIC = [
    "vulnerability", "security fix", "exploit", "attack", "CVE-", "GHSA-", "panic", "crash", "hang", "deadlock", "DoS", "denial of service", "OOM",
    "race condition", "TOCTOU", "injection", "bypass", "spoof", "hijack", "privilege escalation", "authentication bypass", "access control",
]

GROUPS: dict[str, list[str]] = {
    "key_material": KEY_MATERIAL, "signing": SIGNING, "approval": APPROVAL, "transport": TRANSPORT, "ui_deception": UI_DECEPTION, "platform": PLATFORM,
    "contract": CONTRACT, "mpc": MPC, "memory": MEMORY, "supply_chain": SUPPLY_CHAIN, "generic": GENERIC,
}
WEIGHTS: dict[str, float] = {
    "key_material": 1.00, "signing": 0.90, "mpc": 0.90, "contract": 0.75, "approval": 0.75, "supply_chain": 0.70, "transport": 0.65, "platform": 0.60, "memory": 0.60, "ui_deception": 0.55, "generic": 0.35,
}
STRONG_GROUPS = ("key_material", "signing", "mpc", "contract", "approval", "supply_chain")
MODERATE_GROUPS = ("transport", "ui_deception", "platform", "memory", "generic")
STRONG_WORDS = r"vulnerabilit(?:y|ies)|exploit|RCE|remote code exec(?:ution)?|arbitrary code|use.after.free|double.free|heap (?:overflow|corruption)|buffer overflow|out.of.bounds|memory corruption|unsound(?:ness)?|privilege escal|auth(?:entication)? bypass|steal(?:ing)? funds|loss of funds|fund loss|drain(?:ed|ing)? (?:wallet|funds)"
MODERATE_WORDS = r"hang|deadlock|livelock|data race|infinite loop|unbounded|assertion|malformed|untrusted|sanitiz|validate|underflow"

SENSITIVE_PATHS = [
    "keyring", "keystore", "keychain", "vault", "seed", "mnemonic", "bip39", "bip32", "hdkey", "derivation", "entropy", "csprng", "crypto", "cipher",
    "encrypt", "decrypt", "signer", "signing", "signature", "sign", "transaction", "psbt", "approve", "allowance", "permission", "permissions",
    "provider", "session", "pairing", "deeplink", "webview", "content-script", "origin", "secure element", "secure_element",
    "bootloader", "firmware", "applet", "passkey", "webauthn", "account", "wallet", "auth", "password", "unlock", "auto-lock",
    "phishing", "blocklist", "allowlist",
]
STANDARDS: dict[str, list[str]] = {
    "bip32": ["BIP32", "BIP-32", "bip32", "hardened derivation"],
    "bip39": ["BIP39", "BIP-39", "bip39", "mnemonic checksum"],
    "bip44": ["BIP44", "BIP-44", "derivation path"],
    "bip174": ["BIP174", "BIP-174", "PSBT"],
    "slip10": ["SLIP-0010", "SLIP10", "slip10"],
    "slip39": ["SLIP-0039", "SLIP39", "shamir backup"],
    "eip712": ["EIP-712", "EIP712", "signTypedData", "domain separator"],
    "eip155": ["EIP-155", "EIP155", "chain id replay"],
    "eip1271": ["EIP-1271", "EIP1271", "isValidSignature"],
    "eip4337": ["ERC-4337", "EIP-4337", "userOp", "validateUserOp"],
    "eip2612": ["EIP-2612", "ERC-2612", "permit"],
    "eip3085": ["EIP-3085", "wallet_addEthereumChain"],
    "caip": ["CAIP-2", "CAIP-10", "CAIP-25"],
    "rfc6979": ["RFC6979", "RFC 6979", "deterministic nonce"],
}
CORE_TERMS = [
    "security", "vulnerability", "CVE-", "exploit", "private key", "seed", "mnemonic", "entropy", "keystore", "keyring",
    "signature", "signing", "nonce", "replay", "approval", "allowance", "phishing", "spoof", "origin", "permission", "bypass", "leak",
    "sanitize", "validate", "overflow", "crash",
]
CATEGORY_TERMS: dict[str, list[str]] = {
    "browser_extension": ["postMessage", "content script", "XSS", "provider", "dapp"],
    "mobile": ["deeplink", "webview", "keychain", "biometric", "backup"],
    "desktop": ["password", "encrypt", "storage", "RPC"],
    "hardware_firmware": ["bootloader", "secure element", "PIN", "fault", "constant time"],
    "smart_account": ["reentrancy", "delegatecall", "initializer", "validateUserOp", "audit"],
    "mpc_tss": ["share", "DKG", "proof", "commitment", "biased"],
    "wallet_sdk": ["derivation", "BIP32", "encoding", "ECDSA", "prototype pollution"],
    "node_wallet": ["wallet", "RPC", "descriptor", "PSBT"],
    "infra": ["session", "pairing", "relay", "origin", "URI"],
}
LANGUAGE_TERMS: dict[str, list[str]] = {
    "c": ["buffer overflow", "memcpy", "out of bounds"],
    "cpp": ["buffer overflow", "use after free", "uninitialized"],
    "rust": ["unwrap", "panic", "unsound", "RUSTSEC"],
    "go": ["panic", "nil pointer", "data race"],
    "js": ["prototype pollution", "XSS", "unsafe-eval"],
    "python": ["traceback", "eval", "pickle"],
    "java": ["IllegalStateException", "NullPointerException"],
    "solidity": ["reentrancy", "unchecked", "invariant"],
    "swift": ["keychain", "crash"],
    "kotlin": ["keystore", "crash"],
    "csharp": ["NullReferenceException"],
    "dart": ["exception"],
}

SEVERITY_RANK = {"": 0, "Unrated": 1, "Info": 2, "Low": 3, "Medium": 4, "High": 5, "Critical": 6}
RATED = ("critical", "high", "medium", "low")
HIGH = ("critical", "high")
STRIDE = ("Spoofing", "Tampering", "Repudiation", "Information Disclosure", "Denial of Service", "Elevation of Privilege", "Other")
ISSUE_PREFIXES = ("GHSA-", "PR#", "ISSUE#", "COMMIT#", "CHANGELOG#", "RELEASE#")
SOURCE_EXTENSIONS = (
    ".ts", ".tsx", ".js", ".jsx", ".mjs", ".cjs", ".go", ".rs", ".py", ".c", ".cc", ".cpp", ".cxx", ".h", ".hpp", ".java", ".kt", ".kts", ".swift",
    ".m", ".mm", ".sol", ".nim", ".dart", ".rb", ".cs", ".scala", ".ex", ".exs", ".hs", ".ml", ".zig", ".vy", ".move", ".cairo", ".S", ".asm",
)
