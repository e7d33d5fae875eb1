"""Segments: which methods pair up, how human parts are told apart, how fields match and merge."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from braidwork.functions.merging import Policy

#: Array path -> key spec of its items (dash-separated paths inside an item).
ARRAY_KEYS: dict[str, str] = {
    "tradelines": "accountNumber-customerNumber-dateOpened",
    "addresses": "streetNumber-postalCode",
    "collections": "accountNumber-customerNumber-dateAssigned",
    "bankruptcies": "caseNumber-courtCustomerOrder-dateFiled",
    "creditReportHeader": "customerNumber",
    "fileInquiries": "customerNumber-dateOfInquiry-endUserDescriptionOrAcisCaseNumber",
    "employments": "employmentType-employer-occupation",
    "alsoKnownAs": "firstName-lastName-middleName",
    "otherNames": "firstName-lastName-middleName",
    "otherIdentifications": "typeCode-identificationNumber",
    "nonreportedAddresses": "streetNumber-zipCode",
    "nonreportedDatesOfBirth": "nonreportedDateOfBirth",
    "nonreportedEmployments": "employer-occupation",
    "nonreportedInquiries": "date-memberName",
    "nonreportedNames": "firstName-lastName-middleName",
    "nonreportedPublicRecords": "filedDate-caseNumber",
    "nonreportedSsns": "nonreportedSsn",
    "nonreportedPhoneNumbers": "nonreportedPhoneNumber",
    "nonreportedTrades": "accountNumber-customerName-openedDate",
    "nonreportedCollections": "clientName-accountNumber",
    "documentProofs": "authenticationType-document",
    "tradelines.tradelineRequested.disputeCodes": "code",
    "addresses.addressRequested.disputeCodes": "code",
    "collections.collectionRequested.disputeCodes": "code",
    "bankruptcies.bankruptcyRequested.disputeCodes": "code",
    "creditReportHeader.dateOfBirthRequested.disputeCodes": "code",
    "creditReportHeader.currentNameRequested.disputeCodes": "code",
    "creditReportHeader.socialSecurityNumberRequested.disputeCodes": "code",
    "fileInquiries.fileInquiryRequested.disputeCodes": "code",
    "employments.employmentRequested.disputeCodes": "code",
    "alsoKnownAs.alsoKnownAsRequested.disputeCodes": "code",
    "otherNames.otherNameRequested.disputeCodes": "code",
    "otherIdentifications.otherIdentificationRequested.disputeCodes": "code",
    "nonreportedAddresses.disputeCodes": "code",
    "nonreportedAddresses.consumerCommunications": "code",
    "nonreportedDatesOfBirth.disputeCodes": "code",
    "nonreportedDatesOfBirth.consumerCommunications": "code",
    "nonreportedEmployments.disputeCodes": "code",
    "nonreportedEmployments.consumerCommunications": "code",
    "nonreportedInquiries.disputeCodes": "code",
    "nonreportedInquiries.consumerCommunications": "code",
    "nonreportedNames.disputeCodes": "code",
    "nonreportedNames.consumerCommunications": "code",
    "nonreportedPublicRecords.disputeCodes": "code",
    "nonreportedPublicRecords.consumerCommunications": "code",
    "nonreportedSsns.disputeCodes": "code",
    "nonreportedSsns.consumerCommunications": "code",
    "nonreportedPhoneNumbers.disputeCodes": "code",
    "nonreportedPhoneNumbers.consumerCommunications": "code",
    "nonreportedTrades.disputeCodes": "code",
    "nonreportedTrades.consumerCommunications": "code",
    "nonreportedCollections.disputeCodes": "code",
    "nonreportedCollections.consumerCommunications": "code",
}
#: Array path -> parent path of arrays whose left-over items pair up by rank.
SOFT_ARRAYS: dict[str, str] = {
    "tradelines.tradelineRequested.disputeCodes": "tradelines",
    "addresses.addressRequested.disputeCodes": "addresses",
    "collections.collectionRequested.disputeCodes": "collections",
    "bankruptcies.bankruptcyRequested.disputeCodes": "bankruptcies",
    "creditReportHeader.dateOfBirthRequested.disputeCodes": "creditReportHeader",
    "creditReportHeader.currentNameRequested.disputeCodes": "creditReportHeader",
    "creditReportHeader.socialSecurityNumberRequested.disputeCodes": "creditReportHeader",
    "fileInquiries.fileInquiryRequested.disputeCodes": "fileInquiries",
    "employments.employmentRequested.disputeCodes": "employments",
    "alsoKnownAs.alsoKnownAsRequested.disputeCodes": "alsoKnownAs",
    "otherNames.otherNameRequested.disputeCodes": "otherNames",
    "otherIdentifications.otherIdentificationRequested.disputeCodes": "otherIdentifications",
    "nonreportedAddresses.disputeCodes": "nonreportedAddresses",
    "nonreportedDatesOfBirth.disputeCodes": "nonreportedDatesOfBirth",
    "nonreportedEmployments.disputeCodes": "nonreportedEmployments",
    "nonreportedInquiries.disputeCodes": "nonreportedInquiries",
    "nonreportedNames.disputeCodes": "nonreportedNames",
    "nonreportedPublicRecords.disputeCodes": "nonreportedPublicRecords",
    "nonreportedSsns.disputeCodes": "nonreportedSsns",
    "nonreportedPhoneNumbers.disputeCodes": "nonreportedPhoneNumbers",
    "nonreportedTrades.disputeCodes": "nonreportedTrades",
    "nonreportedCollections.disputeCodes": "nonreportedCollections",
}
#: Arrays whose items are united when the cases of a main payload merge.
UNITED_ARRAYS = (
    "tradelines",
    "addresses",
    "collections",
    "bankruptcies",
    "fileInquiries",
    "employments",
    "alsoKnownAs",
    "otherNames",
    "otherIdentifications",
    "nonreportedAddresses",
    "nonreportedDatesOfBirth",
    "nonreportedEmployments",
    "nonreportedInquiries",
    "nonreportedNames",
    "nonreportedPublicRecords",
    "nonreportedSsns",
    "nonreportedPhoneNumbers",
    "nonreportedTrades",
    "nonreportedCollections",
    "documentProofs",
)
#: Merge policies by segment name; the configuration text can't change them.
POLICIES: dict[str, Policy] = {
    "main": Policy(
        arrays=frozenset(UNITED_ARRAYS),
        item_keys=ARRAY_KEYS | {"addresses": "addressType"},
        priority={"addresses": "addressRequested"},
        atomic={"creditReportHeader": ("dateOfBirthRequested", "currentNameRequested", "socialSecurityNumberRequested"), "resultOfInvestigation": (), "requestor": ()},
    ),
    "authanddocreview": Policy(arrays=frozenset({"documentProofs"}), item_keys=ARRAY_KEYS),
}


@dataclass(frozen=True)
class SubType:
    name: str
    discriminator: str
    negative: str | None = None
    is_base: bool = False
    proofs_field: str | None = None
    proofs_label: str | None = None


@dataclass(frozen=True)
class Segment:
    name: str
    ai_method: str
    human_method: str
    payload_format: str | None = None
    sub_types: tuple[SubType, ...] = ()
    field_mappings: tuple[tuple[str, str], ...] = ()
    segment_types: tuple[tuple[str, str], ...] = ()

    @property
    def policy(self) -> Policy:
        return POLICIES.get(self.name, Policy(item_keys=ARRAY_KEYS))

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(s.name for s in self.sub_types) or ("default",)

    @property
    def base(self) -> str | None:
        return next((s.name for s in self.sub_types if s.is_base), None)


def without_comments(node):
    """Drop ``_comment…`` keys at every depth."""
    if isinstance(node, dict):
        return {k: without_comments(v) for k, v in node.items() if not k.startswith("_comment")}
    return [without_comments(x) for x in node] if isinstance(node, list) else node


def parse_segments(text: str) -> tuple[Segment, ...]:
    """Segments of a JSON array; ValueError says what is wrong with it."""
    rows = without_comments(json.loads(text))
    if not isinstance(rows, list) or not rows:
        raise ValueError("segments: a non-empty array is needed")
    found = []
    for row in rows:
        for key in ("name", "aiMethod", "humanMethod"):
            if not str(row.get(key) or "").strip():
                raise ValueError(f"segment {row.get('name')!r}: {key} is missing")
        subs = []
        for s in row.get("humanSubTypes") or []:
            for key in ("name", "discriminatorField"):
                if not str(s.get(key) or "").strip():
                    raise ValueError(f"segment {row['name']!r}: a sub-type lacks {key}")
            subs.append(SubType(s["name"], s["discriminatorField"], s.get("negativeDiscriminatorField"), bool(s.get("isBase")), s.get("docProofsField"), s.get("docProofsLabel")))
        if len(subs) == 1:
            raise ValueError(f"segment {row['name']!r}: a single sub-type could never be complete")
        if row["aiMethod"] == row["humanMethod"]:
            raise ValueError(f"segment {row['name']!r}: both sides have one method")
        mappings = tuple((m["humanField"], m["aiField"]) for m in row.get("fieldMappings") or [])
        types = tuple((root, m["segmentType"]) for m in row.get("segmentTypeMappings") or [] for root in m["roots"])
        found.append(Segment(row["name"], row["aiMethod"], row["humanMethod"], row.get("payloadFormat"), tuple(subs), mappings, types))
    if len({s.name for s in found}) < len(found):
        raise ValueError("segments: names repeat")
    sides: dict[str, str] = {}
    for s in found:
        for method, side in ((s.ai_method, "ai"), (s.human_method, "human")):
            if sides.setdefault(method, side) != side:
                raise ValueError(f"method {method!r} is on both sides")
    return tuple(found)


@dataclass(frozen=True)
class Options:
    """Options of a run; ``as_of`` is the run's time, so that a rerun gives the same rows."""

    ai_source: str
    human_source: str
    state: str
    results: str
    dead_letters: str
    checkpoint: str
    segments: tuple[Segment, ...]
    image_path: str = "queueImages[0].fileName"
    ai_lookback_hours: int = 6
    human_lookback_days: int = 180
    filter_path: str | None = None
    filter_value: str | None = None
    age_limit_days: int = 7
    array_keys: dict[str, str] = field(default_factory=lambda: dict(ARRAY_KEYS))
    soft_arrays: dict[str, str] = field(default_factory=lambda: dict(SOFT_ARRAYS))

    def __post_init__(self) -> None:
        if bool(self.filter_path) != bool(self.filter_value):
            raise ValueError("a payload filter needs a path and a value")
        if self.ai_lookback_hours <= 0 or self.human_lookback_days <= 0 or self.age_limit_days <= 0:
            raise ValueError("lookbacks and the age limit have to be positive")
